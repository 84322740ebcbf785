"""Helpers that keep a group holding a large share of all rows out of a single task.

Groups are found by exact counts. What a split depends on is a value of the row or
is written out first, so a recomputed task sees the same split.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from studyloom.session import durable

# Rows of one group that a single task may sort.
SECTION_ROWS = 1_000_000
# Rows a task orders on average where these would fill more tasks than the session's shuffle partitions.
TASK_ROWS = 250_000
# Sums of group sizes in which a group that holds more rows than a limit is looked for.
SIZE_SUMS = 65_536
# Most stretches one group is cut into.
MOST_SECTIONS = 5_000


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
               how: str = "left") -> DataFrame:
    """Join on `keys` with null equal to null; the right side's copies are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def large_groups(df: DataFrame, keys: Sequence[str],
                 rows: int | None = None) -> DataFrame | None:
    """Keys of groups with more than `rows` rows, written out; None if there are none.

    Rows are first counted by a hash of the keys into few sums, as a group is never larger than its
    sum; only the groups of sums above the limit are counted one by one.
    """
    most = SECTION_ROWS if rows is None else rows
    hashed = df.select(*keys, F.pmod(F.hash(*keys), F.lit(SIZE_SUMS)).alias("_sum"))
    full = (hashed.groupBy("_sum").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > most).select("_sum"))
    if full.isEmpty():
        return None
    sizes = durable(hashed.join(full, "_sum", "left_semi").groupBy(*keys)
                    .agg(F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") > most).select(*keys))
    return None if sizes.isEmpty() else sizes


def spread_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, a stored table, with groups dealt to so many tasks that the rows of one do not grow with the
    table; unchanged if the session's shuffle partitions are enough. Rows are counted without
    reading a column."""
    tasks = ceil(df.count() / TASK_ROWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def add_sections(df: DataFrame, keys: Sequence[str], position: str,
                 rows: int = SECTION_ROWS) -> DataFrame | None:
    """Number stretches of `position` inside groups larger than `rows`; None if there are none.

    Adds `_section`, which follows the order of `position` and is null in ordinary
    groups. The cut points are quantiles, written out so that every later reading of
    them is the same. `df` is read several times.
    """
    sizes = durable(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") > rows))
    largest = sizes.agg(F.max("_n")).first()[0]
    if largest is None:
        return None
    parts = min(ceil(largest / rows), MOST_SECTIONS)
    shares = [i / parts for i in range(1, parts)]
    cuts = durable(
        match_keys(df, sizes, keys, "inner").groupBy(*keys)
        .agg(F.percentile_approx(position, shares, 10 * MOST_SECTIONS).alias("_cuts")))
    return match_keys(df, cuts, keys).withColumn(
        "_section", F.size(F.filter("_cuts", lambda c: c < F.col(position)))).withColumn(
        "_section", F.when(F.col("_cuts").isNotNull(), F.col("_section"))).drop("_cuts")


def previous_value(df: DataFrame, keys: Sequence[str], position: str, alias: str,
                   rows: int = SECTION_ROWS) -> DataFrame:
    """`lag(position)` inside each group; `position` must be distinct there.

    Large groups are cut into sections, each one takes its first predecessor from
    the end of the section before it.
    """
    cut = add_sections(df, keys, position, rows)
    if cut is None:
        return df.withColumn(alias, F.lag(position).over(
            Window.partitionBy(*keys).orderBy(position)))
    inside = Window.partitionBy(*keys, "_section").orderBy(position)
    along = Window.partitionBy(*keys).orderBy("_section")
    carried = (
        cut.filter(F.col("_section").isNotNull())
        .groupBy(*keys, "_section").agg(F.max(position).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(along))
        .drop("_last")
    )
    lagged = cut.withColumn("_before", F.lag(position).over(inside))
    return (
        match_keys(lagged, carried, [*keys, "_section"])
        .withColumn(alias, F.coalesce("_before", "_carried"))
        .drop("_before", "_carried", "_section")
    )


def _key_ranges(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct `keys` with their rows `_n`, dealt to tasks by ranges of the keys and written once with
    the task's number `_range`, so that every later reading sees the same ranges."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return durable(counts.repartitionByRange(*keys).withColumn(
        "_range", F.spark_partition_id()))


def _rows_before(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`_before`, the number of rows with smaller keys: a running sum inside each range and the
    totals of the ranges before it, one row per range."""
    sizes = ranges.groupBy("_range").agg(F.sum("_n").alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0))
                           .alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(
        Window.unboundedPreceding, -1)
    return ranges.withColumn("_sum", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        offsets, "_range").select(*keys, (F.col("_offset") + F.col("_sum")).alias("_before"))


def number_rows(df: DataFrame, keys: Sequence[str], alias: str, start: int = 1,
                within: Sequence[str] = ()) -> DataFrame:
    """`start + row_number() - 1` over (keys), nulls first, without a task for all of them.

    With `within`, leading keys, numbers start anew for each of their values. Rows with equal keys
    are numbered in any order among themselves. Only the keys take part in the numbering; `df` is
    read once for them and once for its rows, so an expensive one is written out before.
    """
    keys, within = list(keys), list(within)
    ranges = _key_ranges(df, keys)
    numbers, first = _rows_before(ranges, keys), F.lit(0)
    if within:
        heads = numbers.groupBy(*within).agg(F.min("_before").alias("_head"))
        numbers, first = match_keys(numbers, heads, within), F.col("_head")
    numbers = numbers.select(*keys, (F.col("_before") - first + F.lit(start)).alias(alias))
    numbered = match_keys(df, numbers, keys)
    if ranges.where("_n > 1").isEmpty():
        return numbered
    same = Window.partitionBy(*keys).orderBy(F.lit(0))
    return numbered.withColumn(alias, F.col(alias) + F.row_number().over(same) - 1)
