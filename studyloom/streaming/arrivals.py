"""Series whose slices arrive over time, analysed once they are whole.

The slices of a series are keyed stream state. A series is released when as many slices have
arrived as it should have, or when none has arrived for a while; a slice that comes later
opens it again, and its next release has all slices so far. What is analysed is what a batch run
over the same slices would analyse.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from studyloom.operators import series
from studyloom.sinks.stores import overwrite_batch
from studyloom.streaming.incremental import latest_results

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Slices of a released series that lie in one data frame.
_CHUNK = 10_000
RELEASED = "slice string, release int, reason string"


class _Series(StatefulProcessor):
    """Holds the slices of a series as text on disk, and beside them only counts and a time."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.slices = handle.getListState("slices", "slice string")
        self.counts = handle.getValueState(
            "counts", "arrived long, expected long, due long, release int")

    def _release(self, arrived: int, expected: int, release: int,
                 reason: str) -> Iterator[pd.DataFrame]:
        self.counts.update((arrived, expected, 0, release))
        held = []
        for (text,) in self.slices.get():
            held.append(text)
            if len(held) == _CHUNK:
                yield self._rows(held, release, reason)
                held = []
        if held:
            yield self._rows(held, release, reason)

    @staticmethod
    def _rows(texts: list[str], release: int, reason: str) -> pd.DataFrame:
        return pd.DataFrame({"slice": pd.Series(texts, dtype=object), "release": release,
                             "reason": pd.Series([reason] * len(texts), dtype=object)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived, expected, due, release = (
            self.counts.get() if self.counts.exists() else (0, 0, 0, 0))
        for part in rows:
            self.slices.appendList([(text,) for text in part["slice"]])
            arrived += len(part)
            expected = max(expected, int(part["expected"].max()))
        if due:
            self.handle.deleteTimer(due)
        if 0 < expected <= arrived:
            yield from self._release(arrived, expected, release + 1, "complete")
            return
        due = timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms
        self.handle.registerTimer(due)
        self.counts.update((arrived, expected, due, release))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        arrived, expected, _, release = self.counts.get()
        yield from self._release(arrived, expected, release + 1, "quiet")

    def close(self) -> None:
        pass


def released_slices(slices: DataFrame, keys: Sequence[str], quiet_seconds: float,
                    expected: str | None = None) -> DataFrame:
    """Stream of the slices of released series, with `release` (from 1) and `reason`.

    `expected` names a column with the number of slices a series should have; the largest value
    counts, null or 0 says nothing. A series is `complete` with that many slices, repeated ones
    counted, else `quiet` after `quiet_seconds` without a new one. Each release repeats all slices
    of the series, in the columns of `slices`. A null key is a key. A series is kept in the state
    for good: a slice may come at any time.

    A clock without rows lies beside the slices: after a restart Spark runs no micro-batch for
    timers alone.
    """
    spark = slices.sparkSession
    spark.conf.set(_STORE, _ROCKSDB)
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load().filter(F.lit(False))
    number = F.coalesce(F.col(expected).try_cast("long"), F.lit(0)) if expected else F.lit(0)
    held = slices.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.to_json(F.struct(*slices.columns)).alias("slice"),
        number.cast("long").alias("expected"))
    held = held.unionByName(clock.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in held.schema]))
    released = held.groupBy(*[f"_key_{i}" for i in range(len(keys))]).transformWithStateInPandas(
        _Series(int(quiet_seconds * 1000)), RELEASED, "Append", "ProcessingTime")
    row = F.from_json("slice", slices.schema)
    return released.select(row.alias("_s"), "release", "reason").select(
        "_s.*", "release", "reason")


def analyse_arrivals(slices: DataFrame, keys: Sequence[str], output: str, checkpoint: str,
                     quiet_seconds: float, expected: str | None = None, every: str | None = None,
                     strict: bool = False) -> StreamingQuery:
    """Analyse every series that is released: `{output}/slices` and `{output}/series`.

    A micro-batch is a partition of both tables, replaced if it is repeated after a failure. Without
    `every`, one micro-batch takes what has arrived and what has become quiet, and the call
    returns when it is written; with it (a time such as "1 minute") the query goes on until it
    is stopped. (`availableNow` would not end, as a state with timers always asks for one more
    micro-batch.)
    """
    def write(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"{number:012d}"
        overwrite_batch(batch, f"{output}/slices", name)
        held = spark.read.schema(batch.schema.add("batch", "string")).parquet(
            f"{output}/slices").filter(F.col("batch") == name).drop("batch")
        analysis = series.series_analysis(held, [*keys, "release", "reason"], strict=strict)
        overwrite_batch(analysis, f"{output}/series", name)

    writer = (released_slices(slices, keys, quiet_seconds, expected).writeStream
              .foreachBatch(write).option("checkpointLocation", checkpoint))
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(once=True).start()
    query.awaitTermination()
    return query


def current_series(analysis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per series: that of its last release."""
    return latest_results(analysis.drop("batch"), keys, "release")
