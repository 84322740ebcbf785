"""Token-id files with Elias-Fano encoded document boundaries.

A store is a folder of shards. A shard holds the ids of a run of documents as one array (2 bytes
each if every id fits, else 4), the document ids, and the ends of the documents as an Elias-Fano
sequence: the lower bits packed, the upper bits in unary, and every 256th one's place for `select`.
Spark's writer commits the shards, so a lost executor leaves no half-written file and any store that
Spark writes to will do. Documents are dealt to shards by ranges of doc_id.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from studyloom.llm.encoding import encode_batches
from studyloom.session import ensure_checkpoint_dir, own

SHARD_IDS = 1_000_000
SAMPLE = 256
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


class EliasFano:
    """A non-decreasing sequence of n numbers up to `top` in about n * (2 + log2(top / n)) bits."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, int(top // max(1, n)).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.int64)
        low = np.packbits(((values[:, None] >> shifts) & 1).astype(np.uint8).ravel())
        ones = (values >> bits) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[ones] = 1
        return cls(n, bits, low.tobytes(), np.packbits(unary).tobytes(),
                   ones[::SAMPLE].astype("<u4").tobytes())

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], dtype="<u4")
        return head.tobytes() + self.low + self.high + self.samples

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, bits, a, b = np.frombuffer(data[:16], "<u4").tolist()
        return cls(n, bits, data[16:16 + a], data[16 + a:16 + a + b], data[16 + a + b:])

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        bits = np.unpackbits(np.frombuffer(
            self.low[first // 8:(first + self.low_bits + 7) // 8], np.uint8))
        bits = bits[first % 8:first % 8 + self.low_bits].astype(np.int64)
        return int((bits << np.arange(self.low_bits)).sum())

    def select(self, i: int) -> int:
        """The i-th number: jump to the sample before it, then count ones byte by byte."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        missing, byte = i % SAMPLE, at // 8
        current = self.high[byte] & (0xFF >> (at % 8))
        while missing >= _ONES[current]:
            missing -= int(_ONES[current])
            byte += 1
            current = self.high[byte]
        place = byte * 8 + int(np.flatnonzero(np.unpackbits(
            np.array([current], np.uint8)))[missing])
        return (place - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every number, as a scan needs them."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8)))[:self.n]
        high = (ones - np.arange(self.n)) << self.low_bits
        if not self.low_bits:
            return high
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8))[:self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.int64)
        return high | (low << np.arange(self.low_bits)).sum(axis=1)


_SHARD = "part int, shard int, n_ids long, width int, doc_ids array<long>, ends binary, ids binary"


def write_store(docs: DataFrame, vocabulary: str, path: str | None = None,
                shard_ids: int = SHARD_IDS) -> str:
    """Encode `docs` (doc_id, text) into a store below `path`, ascending by doc_id; its path.

    Rows without a doc_id come first, equal doc_ids follow each other by text. Null text is empty
    and has the end id alone; repeated rows are stored as often as they are there; an empty table
    gives a store without shards; other columns are ignored. A text of any length is encoded whole and
    lies in one shard. Documents are sorted as texts and encoded after that, so the range sampling does
    not encode anything. Without `path` the store goes with `session.release`.
    """
    spark = docs.sparkSession
    path = path or own(spark, f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}")
    names = ["part", "shard", "n_ids", "width", "doc_ids", "ends", "ids"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(),
             pa.binary()]

    def shard_row(shard: int, doc_ids: list, ids: list[bytes]) -> pa.RecordBatch:
        array = np.frombuffer(b"".join(ids), "<u4")
        width = 2 if not len(array) or int(array.max()) < 1 << 16 else 4
        ends = np.cumsum([len(x) // 4 for x in ids])
        row = [TaskContext.get().partitionId(), shard, len(array), width, doc_ids,
               EliasFano.of(ends).to_bytes(), array.astype(f"<u{width}").tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, doc_ids, ids, held = 0, [], [], 0
        for more_docs, more_ids in encode_batches(batches, vocabulary):
            doc_ids += more_docs
            ids += more_ids
            held += sum(len(x) // 4 for x in more_ids)
            if held >= shard_ids:
                yield shard_row(shard, doc_ids, ids)
                shard, doc_ids, ids, held = shard + 1, [], [], 0
        if doc_ids:
            yield shard_row(shard, doc_ids, ids)

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, _SHARD)
     .write.option("compression", "zstd").parquet(path))
    return path


def read_store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The documents of a store, and where each shard begins.

    Documents: part, shard, doc_id, begin (in the shard), n_tokens, ids (binary, 4 bytes per id).
    Shards: part, shard, base (ids of all shards before), from running sums over one row per
    part and one per shard.
    """
    shards = spark.read.schema(_SHARD).parquet(path)
    sizes = shards.select("part", "shard", "n_ids")
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("part_start"))
    starts = sizes.withColumn("shard_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))) \
        .join(parts, "part").select(
            "part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['width']}")
                ends = EliasFano.from_bytes(row["ends"]).all()
                begins = np.concatenate([[0], ends[:-1]])
                n = len(ends)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, row["part"], np.int32)),
                    pa.array(np.full(n, row["shard"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(begins),
                    pa.array(ends - begins),
                    pa.array([ids[a:b].astype("<u4").tobytes() for a, b in
                              zip(begins.tolist(), ends.tolist())], pa.binary())],
                    names=["part", "shard", "doc_id", "begin", "n_tokens", "ids"])

    documents = shards.select("part", "shard", "width", "doc_ids", "ends", "ids").mapInArrow(
        run, "part int, shard int, doc_id long, begin long, n_tokens long, ids binary")
    return documents, starts


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store: doc_id, start, n_tokens, ids_crc32; no rows for an empty store.

    Null doc_ids and repeated documents are given as they were stored.
    """
    documents, starts = read_store(spark, path)
    narrow = documents.select("part", "shard", "doc_id", "begin", "n_tokens",
                              F.crc32("ids").alias("ids_crc32"))
    return narrow.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
