"""Columnar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# A table of more splits per core than this has enough tasks whatever its splits hold.
SPLITS_A_CORE = 2


def read_table(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """Read a Parquet table.

    A split without the beginning of a row group holds no rows, so a small table of one row group
    keeps all later row-wise work on one core however many splits it has. `spread_by` names a
    column to spread such a table by: one with few splits, of which fewer than half the cores hold
    rows. They are counted without reading a column. Larger tables are left as they are.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread_by is None or df.rdd.getNumPartitions() > SPLITS_A_CORE * cores:
        return df
    if df.select(F.spark_partition_id()).distinct().count() > cores // 2:
        return df
    return df.repartition(cores, spread_by)
