"""Packing token ids into sequences by balanced attention cost.

A document's cost in a sequence is linear in its tokens plus quadratic in them, as attention stays
within a document. Documents longer than a sequence are cut into whole sequences and a rest. The
rests of a block of documents, longest first, go one by one to the sequence with the lowest
cost so far among those with room for it; there are just as many sequences as the tokens need, so a
rest that fits nowhere is cut over the emptiest ones. A block leaves fewer free places than one
sequence has. Blocks are runs of rows of one partition with a bounded number of tokens: no
shuffle, and nothing to gather.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.encoding import encode_batches

LENGTH = 1024
BLOCK_TOKENS = 1_000_000
#: Cost of a piece of n tokens: n * LINEAR + n * n * QUADRATIC.
LINEAR, QUADRATIC = 1.0, 1.0 / 512


def assign(lengths: np.ndarray, size: int = LENGTH, linear: float = LINEAR,
           quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a block.

    Every token lies in exactly one piece, and the pieces of a sequence fill it from 0 on
    without a gap. Ties go to the earlier document and the lower sequence.
    """
    pieces, sequence = [], 0
    rests = []
    for d, n in enumerate(lengths):
        n = int(n)
        for start in range(0, n - size + 1, size):
            pieces.append((d, start, size, sequence, 0))
            sequence += 1
        if n % size:
            rests.append((n % size, d, n - n % size))
    rests.sort(key=lambda r: (-r[0], r[1]))
    count = -(-sum(r[0] for r in rests) // size)
    room = np.full(count, size, dtype=np.int64)
    cost = np.zeros(count)
    for n, d, start in rests:
        while n:
            fits = np.where(room >= n, cost, np.inf)
            s = int(np.argmin(fits)) if count else 0
            if fits[s] == np.inf:
                s = int(np.argmax(room))
            part = min(n, int(room[s]))
            pieces.append((d, start, part, sequence + s, size - int(room[s])))
            room[s] -= part
            cost[s] += linear * part + quadratic * part * part
            n, start = n - part, start + part
    return pieces


_PIECES = ("doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64())])


def _block(ids: list[bytes], doc_ids: list, first: int, size: int, linear: float,
           quadratic: float) -> tuple[pa.RecordBatch, int]:
    """The pieces of a block and the number of its sequences, numbered from `first`."""
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    pieces = assign(lengths, size, linear, quadratic)
    own = [ids[d][4 * start:4 * (start + n)] for d, start, n, _, _ in pieces]
    at = np.array(pieces, dtype=np.int64).reshape(-1, 5)
    batch = pa.RecordBatch.from_arrays([
        pa.array([doc_ids[d] for d in at[:, 0].tolist()], pa.int64()),
        pa.array(at[:, 1]), pa.array(at[:, 2]), pa.array(own, pa.binary()),
        pa.array([zlib.crc32(x) for x in own], pa.int64()), pa.array(lengths[at[:, 0]]),
        pa.array(at[:, 3] + first), pa.array(at[:, 4])], schema=_SCHEMA)
    return batch, int(at[:, 3].max()) + 1 if len(at) else 0


def _pack_stream(documents: Iterator[tuple[list, list[bytes]]], size: int, linear: float,
                 quadratic: float, block_tokens: int) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 33
    ids, doc_ids, held = [], [], 0
    for more_docs, more_ids in documents:
        for doc_id, x in zip(more_docs, more_ids):
            if not x:
                continue
            ids.append(x)
            doc_ids.append(doc_id)
            held += len(x) // 4
            if held >= block_tokens:
                out, used = _block(ids, doc_ids, first, size, linear, quadratic)
                yield out
                first, ids, doc_ids, held = first + used, [], [], 0
    if ids:
        yield _block(ids, doc_ids, first, size, linear, quadratic)[0]


def pack(encoded: DataFrame, size: int = LENGTH, linear: float = LINEAR,
         quadratic: float = QUADRATIC, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of the documents in `encoded` (doc_id, ids as 4-byte little-endian).

    Returns doc_id, start, length, ids (binary), ids_crc32, doc_tokens, sequence_id, offset.
    sequence_id is unique: the partition in its upper bits, a running number below. A row without
    ids (null or empty) gives no piece; equal doc_ids are documents of their own; a null doc_id
    stays null; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = ((b.column("doc_id").to_pylist(), b.column("ids").to_pylist())
                     for b in batches)
        return _pack_stream(documents, size, linear, quadratic, block_tokens)

    return encoded.select("doc_id", "ids").mapInArrow(run, _PIECES)


def pack_texts(docs: DataFrame, vocabulary: str, size: int = LENGTH, linear: float = LINEAR,
               quadratic: float = QUADRATIC, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """`pack` for the ids of texts (doc_id, text), encoded by the same task.

    A null or empty text has the end id alone, so each row gives a piece; a null doc_id stays null;
    equal rows are documents of their own; an empty table gives no rows; other columns are ignored.
    Texts are encoded whole, and one of any length is cut into whole sequences and a rest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_stream(encode_batches(batches, vocabulary), size, linear, quadratic,
                            block_tokens)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, _PIECES)
