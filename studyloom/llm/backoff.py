"""Stupid-backoff language-model scores against the counts of all other documents.

1. Documents are gathered into blocks of bounded size, their words as numbers of a block vocabulary.
2. Each block lists its distinct n-grams of every order with counts. A 64-bit hash deals them to
   buckets, so many that a bucket's count table fits into a task; inside a bucket the whole hashes are
   sorted and kept as compressed differences. A frequent n-gram is one entry per block, however often
   it occurs.
3. A bucket joins the lists: it sums the counts per n-gram and answers each block with the totals of
   the n-grams it listed, in their order.
4. A block joins its answers to its exploded n-grams, takes off what the document itself
   contributed, backs off where nothing is left, and sums per document.

N-grams are told apart by 64 bits of hash. There are at least as many tasks as buckets, so that what
a task reads does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.words import Words, drop_kept, slices, window_hashes
from studyloom.session import durable

ORDER, ALPHA = 3, 0.4
#: Count of a word that no other document has.
UNSEEN = 0.5
BLOCK_WORDS = 1_000_000
BUCKET_NGRAMS = 2_000_000


def _packed(values: np.ndarray, width: int) -> bytes:
    """Non-negative integers as compressed byte planes: sorted or small ones take little room."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    raw = np.ascontiguousarray(planes).tobytes()
    return len(values).to_bytes(4, "little") + bytes([width]) + pa.Codec("zstd").compress(
        raw, asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:4], "little"), data[4]
    raw = pa.Codec("zstd").decompress(data[5:], n * width, asbytes=True)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel().astype(np.int64)


def _width(values: np.ndarray) -> int:
    return max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)


_BLOCK = ("block long, doc_ids array<long>, n_words array<int>, words long, vocabulary binary, "
          "numbers binary")


def _blocks(docs: DataFrame, block_words: int) -> DataFrame:
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(),
             pa.binary()]

    def row(block: int, ids: list, counts: list, hashes: list) -> pa.RecordBatch:
        all_hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        vocabulary, numbers, uses = np.unique(all_hashes, return_inverse=True, return_counts=True)
        # frequent words get small numbers, which take less room
        order = np.argsort(-uses, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        vocabulary, numbers = vocabulary[order], rank[numbers]
        values = [block, ids, np.concatenate(counts), len(numbers),
                  _packed(vocabulary, 8), _packed(numbers, _width(numbers))]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types)], names=names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        block = TaskContext.get().partitionId() << 33
        ids, counts, hashes, held = [], [], [], 0
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), lower=True)
                ids += part.column("doc_id").to_pylist()
                counts.append(words.counts())
                hashes.append(words.hashes())
                held += len(words)
                if held >= block_words:
                    yield row(block, ids, counts, hashes)
                    block, ids, counts, hashes, held = block + 1, [], [], [], 0
        if ids:
            yield row(block, ids, counts, hashes)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        gather, _BLOCK)


class _Grams:
    """The n-grams of one order in a block, dealt to buckets by the leading bits of their hash.

    `at` has the place of each one's last word; `which` its number among the distinct n-grams in
    order of their hash, and so of their bucket. `low` is the hash less the bucket's first one.
    """

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, order: int, buckets: int):
        every = window_hashes(hashes, order)
        whole = starts[order - 1:] >= order - 1  # words since the document's first
        self.at = np.flatnonzero(whole) + order - 1
        distinct, self.which = np.unique(every[whole], return_inverse=True)
        half, number = np.uint64(32), np.uint64(buckets)
        self.bucket = ((distinct >> half) * number) >> half
        self.low = distinct - (((self.bucket << half) // number) << half)

    def lists(self) -> Iterator[tuple[int, bytes, bytes]]:
        counts = np.bincount(self.which, minlength=len(self.low))
        edge = np.flatnonzero(np.concatenate([[1], np.diff(self.bucket)])) if len(
            self.bucket) else np.empty(0, int)
        for a, b in zip(edge, [*edge[1:], len(self.low)]):
            steps = np.diff(self.low[a:b], prepend=np.uint64(0))
            yield (int(self.bucket[a]), _packed(steps, _width(steps)),
                   _packed(counts[a:b], _width(counts[a:b])))


def _words_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a block, each word's place in its document, and the document's number."""
    vocabulary = _unpacked(row["vocabulary"]).view(np.uint64)
    hashes = vocabulary[_unpacked(row["numbers"])]
    counts = np.asarray(row["n_words"], dtype=np.int64)
    first = np.cumsum(counts) - counts
    return hashes, np.arange(len(hashes)) - np.repeat(first, counts), np.repeat(
        np.arange(len(counts)), counts)


def _totals(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(block, level, bucket, totals): for each list that a block sent, the sums over all blocks."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                hashes, places, _ = _words_of(row)
                for level in range(1, order + 1):
                    lists = list(_Grams(hashes, places, level, buckets).lists())
                    if lists:
                        n = len(lists)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([x[0] for x in lists], pa.int64()),
                            pa.array([level] * n, pa.int32()),
                            pa.array([row["block"]] * n, pa.int64()),
                            pa.array([x[1] for x in lists], pa.binary()),
                            pa.array([x[2] for x in lists], pa.binary())],
                            names=["bucket", "level", "block", "keys", "counts"])

    def answer(group: list[dict]) -> pa.RecordBatch:
        keys = [np.cumsum(_unpacked(r["keys"])) for r in group]
        table, where = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(where, weights=np.concatenate(
            [_unpacked(r["counts"]) for r in group]), minlength=len(table)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        found = [sums[where[e - len(k):e]] for k, e in zip(keys, ends)]
        return pa.RecordBatch.from_arrays([
            pa.array([r["block"] for r in group], pa.int64()),
            pa.array([r["level"] for r in group], pa.int32()),
            pa.array([r["bucket"] for r in group], pa.int64()),
            pa.array([_packed(t, _width(t)) for t in found], pa.binary())],
            names=["block", "level", "bucket", "totals"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        current, group = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (key := (row["bucket"], row["level"])) != current:
                    if group:
                        yield answer(group)
                    current, group = key, []
                group.append(row)
        if group:
            yield answer(group)

    return (blocks.mapInArrow(explode, "bucket long, level int, block long, keys binary, "
                                       "counts binary")
            .repartition(buckets, "bucket").sortWithinPartitions("bucket", "level", "block")
            .mapInArrow(join, "block long, level int, bucket long, totals binary"))


def _own_counts(which: np.ndarray, document: np.ndarray, n: int) -> np.ndarray:
    """How often each occurrence's n-gram occurs in its own document."""
    _, inverse, counts = np.unique(document * max(1, n) + which, return_inverse=True,
                                   return_counts=True)
    return counts[inverse]


def _scores(row: dict, totals: dict[int, list[np.ndarray]], order: int, alpha: float, buckets: int,
            all_words: int, leave_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log score per document of a block, and how many words backed off from the longest history."""
    hashes, places, document = _words_of(row)
    lengths = np.asarray(row["n_words"], dtype=np.int64)
    rest = np.maximum(all_words - lengths * leave_out, 1)[document].astype(np.float64)
    score, before, backed = None, None, np.zeros(len(hashes), dtype=bool)
    for level in range(1, order + 1):
        grams = _Grams(hashes, places, level, buckets)
        count = np.zeros(len(hashes))
        if len(grams.at):
            left = np.concatenate(totals[level])[grams.which]
            if leave_out:
                left = left - _own_counts(grams.which, document[grams.at], len(grams.low))
            count[grams.at] = left
        if level == 1:
            score = np.where(count > 0, count, UNSEEN) / rest
        else:
            history = np.concatenate([[0.0], before[:-1]])
            known = count > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                longer = np.where(known, count / history, alpha * score)
            there = places >= level - 1  # no history of this length at a document's start
            score = np.where(there, longer, score)
            if level == order:
                backed = there & ~known
        before = count
    sums = np.bincount(document, weights=np.log(score), minlength=len(lengths))
    return sums, np.bincount(document, weights=backed, minlength=len(lengths)).astype(np.int64)


def score_documents(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA,
                    leave_out: bool = True, block_words: int = BLOCK_WORDS,
                    bucket_ngrams: int = BUCKET_NGRAMS) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_backed_off, log_score.

    Words are as `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased. A word's score is c(history word) /
    c(history) for the longest history of up to `order` - 1 words of the same text with a count,
    `alpha` for each word the history was shortened by, c(word) / all words without history, and
    half a count for an unseen word. Counts cover all rows but, with `leave_out`, the scored one.
    log_score is the sum of natural logarithms; n_backed_off counts words whose longest n-gram was not
    found. Null or empty text: 0 words, score 0. Every row is a document of its own; a null
    doc_id stays null; other columns are ignored; an empty table gives no rows.
    """
    blocks = durable(_blocks(docs, block_words))
    all_words = int(blocks.agg(F.sum("words")).first()[0] or 0)
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(count, -(-all_words // bucket_ngrams))
    totals = durable(_totals(blocks, order, buckets))
    empty = F.lit(None)
    tokens = blocks.select("block", F.lit(0).alias("level"), F.lit(0).cast("long").alias("bucket"),
                           empty.cast("binary").alias("totals"), "doc_ids", "n_words",
                           "vocabulary", "numbers")
    answers = totals.select("*", empty.cast("array<long>").alias("doc_ids"),
                            empty.cast("array<int>").alias("n_words"),
                            empty.cast("binary").alias("vocabulary"),
                            empty.cast("binary").alias("numbers"))

    def finish(row: dict, found: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        sums, backed = _scores(row, found, order, alpha, buckets, all_words, leave_out)
        return pa.RecordBatch.from_arrays([
            pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_words"], pa.int64()),
            pa.array(backed, pa.int64()), pa.array(sums, pa.float64())],
            names=["doc_id", "n_words", "n_backed_off", "log_score"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        current, found = None, {}
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["level"] == 0:
                    if current is not None:
                        yield finish(current, found)
                    current, found = row, {k: [] for k in range(1, order + 1)}
                else:
                    found[row["level"]].append(_unpacked(row["totals"]))
        if current is not None:
            yield finish(current, found)

    return (tokens.unionByName(answers).repartition(buckets, "block")
            .sortWithinPartitions("block", "level", "bucket")
            .mapInArrow(score, "doc_id long, n_words long, n_backed_off long, log_score double"))
