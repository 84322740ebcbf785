"""Exact top-k inner products by columnar branch and bound.

Vectors lie in blocks in vertical layout: one array per dimension. A query gathers its scores a few
dimensions at a time; after each step the product of the remaining norms bounds what a candidate
can still gain or lose, candidates that cannot reach the k-th best are dropped, and the
arrays of the survivors are made compact. Queries lie in blocks too; every block of candidates is
sent once to each block of queries, best results of the blocks are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from studyloom.session import durable

CANDIDATES, QUERIES = 2048, 1024
#: Dimensions added per step.
STEP = 8
#: Scores up to here are exact in floating point.
EXACT = float(1 << 52)


def best_of_block(query: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray,
                  tails: np.ndarray, order: np.ndarray, k: int,
                  least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of a query's k best in a block, ties to the smaller id, itself left out.

    `columns` is dimensions x candidates, ids ascending; `tails[s]` holds each candidate's norm
    over the dimensions from step s on, in the order `order`. Scores below `least`, the k-th best
    of other blocks, are not needed.
    """
    alive = np.flatnonzero(ids != own)
    part = np.zeros(len(alive), dtype=columns.dtype)
    exact = np.issubdtype(columns.dtype, np.integer)
    q_tail = np.sqrt(np.cumsum((query[order].astype(np.float64) ** 2)[::-1])[::-1])
    for s, at in enumerate(range(0, len(order), STEP)):
        dims = order[at:at + STEP]
        block = columns[dims][:, alive] if len(alive) < columns.shape[1] else columns[dims]
        part = part + query[dims] @ block
        rest = at + STEP
        if rest >= len(order) or not len(alive):
            continue
        # a hair more than the norms allow, so that rounding never drops a candidate
        slack = q_tail[rest] * tails[s + 1][alive] * (1 + 1e-9) + (1 if exact else 0.5)
        floor = least
        if len(alive) > k:
            low = part - slack
            floor = max(floor, np.partition(low, len(low) - k)[len(low) - k])
        stay = np.flatnonzero(part + slack >= floor)
        if len(stay) < len(alive):
            alive, part = alive[stay], part[stay]
    if len(alive) > k:
        # ids are ascending, so a stable sort gives ties to the smaller id
        top = np.argsort(-part, kind="stable")[:k]
        alive, part = alive[top], part[top]
    return ids[alive], part


def _matrix(vectors: pa.Array) -> np.ndarray:
    """dimensions x vectors; shorter vectors are filled up with zeros."""
    lists = vectors.to_pylist()
    width = max((len(v) for v in lists), default=0)
    out = np.zeros((width, len(lists)), dtype=np.int64)
    for i, v in enumerate(lists):
        out[:len(v), i] = v
    return out


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """One row per block of at most `size` vectors of a partition: ids, dims, data (int64)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            ids = table.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            matrix = _matrix(table.column("vector"))[:, order]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[order].tobytes()], pa.binary()),
                 pa.array([matrix.shape[0]], pa.int32()), pa.array([matrix.tobytes()], pa.binary())],
                names=["ids", "dims", "data"])

        held, n = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, size - n)
                batch = batch.slice(len(part))
                held.append(part)
                n += len(part)
                if n == size:
                    yield out(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield out(pa.Table.from_batches(held))

    return rows.mapInArrow(gather, "ids binary, dims int, data binary")


def floor_scaled(vector: Column, scale: int) -> Column:
    """Every component x as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
        | (F.abs(x.cast("double")) == F.lit(float("inf"))))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """The k highest integer inner products of every query with all other rows.

    `vectors` needs vec_id and embedding; other columns are ignored. Returns query_id, rank (from 1),
    vec_id, score; ties go to the smaller vec_id; fewer rows if there are fewer candidates. Rows with
    a null vec_id or an unusable vector take no part. A row with the query's own vec_id is not
    its candidate; of rows that share a vec_id all count as candidates, and a vec_id that is a query
    in several rows gives the k best over them. Vectors of unequal length are filled up with zeros.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        floor_scaled(F.col("embedding"), scale).alias("vector"))
    queries = durable(_blocks(rows.filter(is_query), QUERIES).withColumn(
        "block", F.monotonically_increasing_id()))
    # one number per 1,024 queries; each candidate block goes to each query block
    blocks = [r.block for r in queries.select("block").collect()]
    # few query blocks are repeated, so that as many tasks as there are partitions share the work
    shares = -(-int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
               // max(1, len(blocks)))
    candidates = _blocks(rows, CANDIDATES).withColumn(
        "share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shares))).withColumn(
        "block", F.explode(F.array(*[F.lit(b).cast("long") for b in blocks])
                           .cast("array<bigint>")))
    repeated = queries.select(
        "block", F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"),
        F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))
        .alias("share"))
    paired = candidates.join(repeated, ["block", "share"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best = None, None
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] != current:
                    if best is not None:
                        yield best.rows()
                    current, best = row["block"], _Best(row, k)
                best.add(row)
        if best is not None:
            yield best.rows()

    found = paired.select("block", "ids", "dims", "data", "q_ids", "q_dims", "q_data") \
        .sortWithinPartitions("block").mapInArrow(
            search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class _Best:
    """The best candidates so far of a block of queries."""

    def __init__(self, row: dict, k: int):
        self.k, self.ids = k, np.frombuffer(row["q_ids"], np.int64)
        self.queries = np.frombuffer(row["q_data"], np.int64).reshape(row["q_dims"], -1)
        none = np.empty(0, np.int64)
        self.found = [(none, none)] * len(self.ids)

    def add(self, row: dict) -> None:
        """Search one block of candidates."""
        ids = np.frombuffer(row["ids"], np.int64)
        columns = np.frombuffer(row["data"], np.int64).reshape(row["dims"], -1)
        dims = min(len(columns), len(self.queries))
        columns, queries = columns[:dims], np.ascontiguousarray(self.queries[:dims].T)
        # dimensions with the most mass first
        order = np.argsort(-(columns.astype(np.float64) ** 2).sum(axis=1), kind="stable")
        squares = columns[order].astype(np.float64) ** 2
        tails = np.sqrt([squares[at:].sum(axis=0) for at in range(0, max(dims, 1), STEP)])
        largest = float(np.abs(columns).max(initial=0)) * float(
            np.abs(queries).max(initial=0)) * dims
        if largest < EXACT:  # floating point is exact here, and faster
            columns, queries = columns.astype(np.float64), queries.astype(np.float64)
        for q, own in enumerate(self.ids.tolist()):
            had, score = self.found[q]
            least = float(score[-1]) if len(had) == self.k else -np.inf
            more, gained = best_of_block(queries[q], own, ids, columns, tails, order, self.k, least)
            if len(more):
                every = np.concatenate([had, more])
                scores = np.concatenate([score, gained.astype(np.int64)])
                top = np.lexsort((every, -scores))[:self.k]
                self.found[q] = every[top], scores[top]

    def rows(self) -> pa.RecordBatch:
        counts = [len(x) for x, _ in self.found]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.ids, counts)),
            pa.array(np.concatenate([x for x, _ in self.found])),
            pa.array(np.concatenate([x for _, x in self.found]))],
            names=["query_id", "vec_id", "score"])
