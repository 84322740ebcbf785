"""Top and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(counts: DataFrame, group: str, count: str, value: str, n: int = 10) -> DataFrame:
    """The n most frequent values per group; Spark limits each task's share before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(count), F.col(value))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows in an order that has no ties."""
    return df.orderBy(*order).limit(n)
