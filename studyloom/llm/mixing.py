"""Mixing sources to target weights by Sainte-Lague apportionment of equal-sized blocks.

Targets come from weights by water filling over the per-source totals (one row per source).
Each source is dealt over shards by a seeded hash of the document id, so many that a shard holds
a bounded number of words however large the source is. Within a shard, documents are laid end to
end in seeded order and cut into blocks of equal size. Highest quotients give every source a whole
number of blocks, and every shard of a source its part of them; what a source's blocks lack to its
target, or have too much, is settled in words over its shards. A shard takes all its words
equally often and one time more the first blocks of a seeded order, the last of them in part.
`mix_whole` fills the same quotas with whole documents instead of blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from studyloom.llm.words import Words, drop_kept
from studyloom.session import durable

BLOCK_WORDS = 64
SHARD_WORDS = 2_000_000
#: Rows with words; rows without take no part in the choice.
SHARD_ROWS = 500_000


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by the highest quotients votes / (2 s + 1); ties go to the earlier party.

    The divisor is bracketed first, so the work does not grow with the number of seats.
    """
    votes = np.asarray(votes, dtype=np.float64)
    out = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return out
    # start below the ideal share and deal out the rest one by one
    share = votes * (seats / votes.sum())
    out = np.maximum(np.floor(share - 0.5 - 0.5 * len(votes) / max(1, seats) * share), 0)
    out = np.minimum(out, np.floor(share)).astype(np.int64)
    while out.sum() > seats:
        out = np.maximum(out - 1, 0)
    heap = [(-v / (2 * s + 1), i) for i, (v, s) in enumerate(zip(votes, out)) if v > 0]
    heapq.heapify(heap)
    for _ in range(int(seats - out.sum())):
        quotient, i = heapq.heappop(heap)
        out[i] += 1
        heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return _settled(votes, out)


def _settled(votes: np.ndarray, seats: np.ndarray) -> np.ndarray:
    """Move seats until the lowest quotient that won is above the highest that did not."""
    if not (votes > 0).any():
        return seats
    while True:
        best = votes / (2 * seats + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            last = np.where(seats > 0, votes / (2 * seats - 1), np.inf)
        gain, lose = int(np.argmax(best)), int(len(last) - 1 - np.argmin(last[::-1]))
        if best[gain] < last[lose] or gain == lose or (
                best[gain] == last[lose] and gain > lose):
            return seats
        seats = seats.copy()
        seats[gain] += 1
        seats[lose] -= 1


def word_counts(docs: DataFrame, others: list[str] = ()) -> DataFrame:
    """doc_id, source, size: the number of words of each text (null: 0); `others` are longs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            sizes = Words(batch.column("text")).counts().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array(sizes),
                 *map(batch.column, others)], names=["doc_id", "source", "size", *others])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("source").cast("string").alias("source"), "text", *others)
    return narrow.mapInArrow(count, "doc_id long, source string, size long"
                             + "".join(f", {name} long" for name in others))


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Per source: source_size, source_rows (those with words), weight, target.

    Sources in code point order, null last, take `weights` in turn. They share `share` times all
    words; a target stops at `most` times its source and the excess goes to the others by
    weight. With sources ordered by capacity per unit of weight, the saturated ones are a prefix,
    so one running sum finds the level of the rest. One row per source goes through the window.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count(F.when(F.col("size") > 0, 1)).alias("source_rows"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(table, (F.col("place") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("top", F.lit(float(most)) * F.col("source_size")).withColumn(
        "ratio", F.col("top") / F.col("weight"))
    along = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "place").rowsBetween(Window.currentRow,
                                                        Window.unboundedFollowing)
    whole = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding,
                                                         Window.unboundedFollowing)
    leveled = (
        ranked.withColumn("all_words", F.sum("source_size").over(whole))
        .withColumn("before", F.coalesce(F.sum("top").over(along), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(rest))
        .withColumn("level", (F.lit(float(share)) * F.col("all_words") - F.col("before"))
                    / F.col("open_weight"))
        # the level of the first source that its own share does not fill; null if all are full
        .withColumn("level", F.min(F.when(F.col("level") < F.col("ratio"), F.struct(
            "ratio", "place", "level"))).over(whole)["level"])
    )
    return leveled.select(
        "source", "source_size", "source_rows", "weight", "place",
        F.when(F.col("level").isNull(), F.col("top"))
        .otherwise(F.least("top", F.col("level") * F.col("weight"))).alias("target"))


def shard_numbers(words: np.ndarray, rows: np.ndarray, shard_words: int,
                  shard_rows: int) -> np.ndarray:
    """Shards of sources with so many words, and rows with words."""
    return np.maximum(1, np.maximum(-(-words // shard_words), -(-rows // shard_rows))).astype(
        np.int64)


def shard_quotas(sizes: np.ndarray, blocks: int, words: int, block_words: int,
                 most: int) -> np.ndarray:
    """Words of each shard of a source: its part of the blocks, settled to come to `words`.

    None is above `most` times the shard. The shards farthest from their share settle first, a block
    at a time.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    top = most * sizes
    quota = np.minimum(sainte_lague(sizes, blocks) * block_words, top)
    share = sizes * (words / max(1, int(sizes.sum())))
    while rest := min(words, int(top.sum())) - int(quota.sum()):
        sign = 1 if rest > 0 else -1
        order = np.argsort(sign * (quota - share), kind="stable")
        room = (top - quota if rest > 0 else quota)[order]
        step = np.minimum(room, max(block_words, -(-abs(rest) // len(sizes))))
        quota[order] += sign * np.clip(abs(rest) - (np.cumsum(step) - step), 0, step)
    return quota


def _pieces(most: float) -> int:
    return max(1, int(most + 0.999999))


def _placed(sizes: DataFrame, weights: list[float], share: float, most: float, seed: int,
            block_words: int, shard_words: int, shard_rows: int) -> DataFrame | None:
    """`sizes` with place, shard, order_key, source_size, target, and the shard's quota in words.

    Rows without words have no quota. None if there are no rows.
    """
    targets = source_targets(sizes, weights, share, most)
    frame = targets.toPandas()  # one row per source
    if frame.empty:
        return None
    frame = frame.sort_values("place").reset_index(drop=True)
    frame["blocks"] = sainte_lague(frame["target"].to_numpy(),
                                   int(round(frame["target"].sum() / block_words)))
    frame["words"] = np.floor(frame["target"].to_numpy() + 0.5).astype(np.int64)
    frame["shards"] = shard_numbers(frame["source_size"].to_numpy(),
                                    frame["source_rows"].to_numpy(), shard_words, shard_rows)
    plan = sizes.sparkSession.createDataFrame(
        frame[["place", "source", "source_size", "target", "blocks", "words", "shards"]]
        .to_dict("records"), "place int, source string, source_size long, target double, "
                             "blocks long, words long, shards long")

    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    placed = (
        sizes.join(plan, sizes["source"].eqNullSafe(plan["source"])).drop(plan["source"])
        .withColumn("order_key", key)
        .withColumn("shard", F.pmod(F.shiftright("order_key", 20), F.col("shards"))))
    per_shard = durable(placed.filter("size > 0").groupBy("place", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("blocks").alias("blocks"),
        F.first("words").alias("words")))
    pieces = _pieces(most)

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard").reset_index(drop=True)
        rows["quota"] = shard_quotas(rows["shard_size"].to_numpy(), int(rows["blocks"].iloc[0]),
                                     int(rows["words"].iloc[0]), block_words, pieces)
        return rows[["place", "shard", "quota"]]

    quotas = per_shard.groupBy("place").applyInPandas(deal, "place int, shard long, quota long")
    return placed.filter("size > 0").join(quotas, ["place", "shard"]).unionByName(
        placed.filter("size = 0"), allowMissingColumns=True)


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0,
        seed: int = 17, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, taken.

    `taken` is the number of words the mix takes of the document, repeats counted; it is at
    most ceil(most) times the size, and of a source it comes to the target rounded half up. Needs doc_id, source and text; other columns are ignored. Null
    text has size 0; null is a source of its own; equal rows are documents of their own; rows
    without an id are ordered by their size. An empty table gives no rows. The result depends on
    the rows, the seed and the sizes named here, not on partitions.
    """
    sizes = durable(word_counts(docs))
    placed = _placed(sizes, weights, share, most, seed, block_words, shard_words,
                     shard_rows)
    if placed is None:
        return sizes.select("doc_id", "source", "size", F.col("size").alias("source_size"),
                            F.lit(0.0).alias("target"), F.col("size").alias("taken"))

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order_key", "doc_id", "size"], kind="stable")
        edges = np.concatenate([[0], np.cumsum(rows["size"].to_numpy())])
        rows["taken"] = np.diff(taken_up_to(
            edges, int(rows["quota"].iloc[0]), block_words,
            [seed, int(rows["place"].iloc[0]), int(rows["shard"].iloc[0])]))
        return rows[[*columns, "taken"]]

    columns = ["doc_id", "source", "size", "source_size", "target"]
    return (placed.filter("size > 0").select("place", "shard", *columns, "order_key", "quota")
            .groupBy("place", "shard").applyInPandas(
                choose, "doc_id long, source string, size long, source_size long, "
                        "target double, taken long")
            .unionByName(placed.filter("size = 0").select(*columns, F.col("size").alias("taken"))))


def taken_up_to(edges: np.ndarray, quota: int, block_words: int, seed: list[int]) -> np.ndarray:
    """Words taken of a shard up to each of its words `edges` (the last is its size)."""
    total = int(edges[-1])
    times, rest = divmod(quota, total)
    starts = np.arange(0, total, block_words)
    length = np.minimum(block_words, total - starts)
    rank = np.random.default_rng(seed).permutation(len(starts))
    more = np.zeros(len(starts), dtype=np.int64)  # first words of a block taken one time more
    more[rank] = np.clip(rest - (np.cumsum(length[rank]) - length[rank]), 0, length[rank])
    before = np.concatenate([[0], np.cumsum(more)])
    block = np.minimum(edges // block_words, len(starts) - 1)
    return times * edges + before[block] + np.minimum(edges - starts[block], more[block])


def whole_copies(sizes: np.ndarray, quota: int, most: int) -> np.ndarray:
    """Copies of documents, in their order, whose words come to `quota` as nearly as may be.

    All have quota // total copies, and one more goes to those, first come first served, whose
    words still fit into the rest; at last the smallest one left has one too if that is nearer.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    copies = np.zeros(len(sizes), dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return copies
    quota = min(quota, most * total)
    copies[:] = quota // total
    rest = quota % total
    first = int(np.searchsorted(np.cumsum(sizes), rest, side="right"))
    copies[:first] += 1
    rest -= int(sizes[:first].sum())
    least = np.minimum.accumulate(sizes[::-1])[::-1]  # of a document and all after it
    left = first
    for at in range(first, len(sizes)):
        if least[at] > rest:
            break
        if sizes[at] <= rest:
            copies[at] += 1
            rest -= int(sizes[at])
    if rest and left < len(sizes):
        open_ = left + np.flatnonzero(copies[left:] == quota // total)
        if len(open_):
            at = open_[np.argmin(sizes[open_])]
            copies[at] += sizes[at] < 2 * rest
    return copies


def _row_keys(docs: DataFrame, seed: int) -> list[Column]:
    """Two hashes that tell rows of different doc_id, source or text apart."""
    return [F.xxhash64(F.lit(seed), docs["doc_id"].cast("long"), docs["source"].cast("string"),
                       docs["text"].isNull()).alias("_mix_row"),
            F.xxhash64(docs["text"]).alias("_mix_text")]


def mix_whole(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0,
              seed: int = 17, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
              shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows of `docs`, each as often as the mix takes it: at most ceil(most) times.

    The words of a source come to its target but for part of its smallest document in each
    shard. Rows equal in doc_id, source and text are taken equally often. Rows without words stay
    as they are. Otherwise as `mix`.
    """
    keys = ["_mix_row", "_mix_text"]
    sizes = durable(word_counts(docs.select("doc_id", "source", "text", *_row_keys(docs, seed)),
                                keys))
    placed = _placed(sizes, weights, share, most, seed, block_words, shard_words,
                     shard_rows)
    if placed is None:
        return docs
    pieces = _pieces(most)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.groupby(["order_key", *keys], as_index=False, sort=True).agg(
            size=("size", "sum"), quota=("quota", "first"))
        rows["copies"] = whole_copies(
            rows["size"].to_numpy(), int(rows["quota"].iloc[0]), pieces)
        return rows[[*keys, "copies"]]

    taken = durable(
        placed.filter("size > 0").select("place", "shard", *keys, "size", "order_key", "quota")
        .groupBy("place", "shard").applyInPandas(
            choose, "_mix_row long, _mix_text long, copies int")
        .unionByName(sizes.filter("size = 0").select(*keys, F.lit(1).alias("copies")).distinct())
        .filter("copies > 0"))
    mark = "_mix"
    while any(c.startswith(mark) for c in docs.columns):  # names that no column of docs has
        mark += "_"
    row, text = _row_keys(docs, seed)
    keyed = docs.select("*", row.alias(f"{mark}_1"), text.alias(f"{mark}_2"))
    copies = taken.select(F.col(keys[0]).alias(f"{mark}_1"), F.col(keys[1]).alias(f"{mark}_2"),
                          F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(f"{mark}_3"))
    return keyed.join(copies, [f"{mark}_1", f"{mark}_2"]).select(*docs.columns)


def repeat_rows(docs: DataFrame, taken: DataFrame, copies: Column | None = None) -> DataFrame:
    """Rows of `docs` as often as the mix takes them, `taken / size` rounded half up.

    `taken` holds doc_id, size and taken; a doc_id that occurs several times is matched with
    the largest of its rows. Documents without words stay as one row.
    """
    per_id = taken.groupBy(F.col("doc_id").alias("_mix_id")).agg(
        F.max("size").alias("_mix_size"), F.max("taken").alias("_mix_taken"))
    times = F.when(F.col("_mix_size") > 0, F.floor(
        (F.col("_mix_taken") + F.col("_mix_size") / 2) / F.col("_mix_size"))).otherwise(F.lit(1))
    joined = docs.join(per_id, docs["doc_id"].cast("long").eqNullSafe(F.col("_mix_id")))
    return (joined.withColumn("_mix_copy", F.explode(F.sequence(
        F.lit(0), times.cast("int")))).filter(F.col("_mix_copy") > 0).select(*docs.columns))
