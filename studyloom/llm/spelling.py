"""Spelling variants by k-d trees over letter-count vectors.

Two words one edit apart have letter counts at most two apart: a replaced letter lowers one count and
raises another, an inserted one raises one. So the words of each length are points of a k-d tree whose
nodes split one letter's count, and a word is a query in the tree of its own length (one count may be
too low and one too high) and in that of the next length (one too low). A box whose limits need more
than that is pruned; in the leaves that are left, letter order decides.

The tree has two parts. Its top is fitted on a bounded sample of the words; its leaves are cells of
about `CELL` words, one group of a Spark shuffle each, and a word goes to its own cell and as a query
to the cells it can reach. Each group builds the rest of the tree for its points and sends the queries
down together. Only counts and best partners leave a cell, no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from studyloom.session import durable

#: Words sampled for the top of the tree; words per cell; points per leaf inside a cell.
SAMPLE, CELL, LEAF = 40_000, 8_192, 48
#: Letter vectors: a-z, and all other code points folded onto 64 more counts.
DIMENSIONS = 26 + 64
#: Pairs compared letter by letter at a time; above `DENSE` in a leaf, masked words are joined instead.
TOGETHER, DENSE = 1 << 19, 1 << 23
POINT, SAME, SHORTER = 0, 1, 2


def planted_words(docs: DataFrame, least_length: int = 5, least_times: int = 3) -> DataFrame:
    """Distinct words of whole texts with their number: word, n.

    Words are runs of Latin letters, A-Z lower-cased. In a document where 97 divides the CRC-32 of
    `doc_id:word`, each of them loses the letter at that number modulo its length (a null doc_id is
    empty text there). Words of fewer letters or times than asked for are left out. Null text: none.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÿ]+)"))).alias("run"))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = runs.select("doc", lower.alias("run"))
    runs = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, cast(h % char_length(run) as int))"),
                   F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= least_length).groupBy("word")
            .agg(F.count("*").alias("n")).where(F.col("n") >= least_times))


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts of each row."""
    n, length = codes.shape
    dims = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % 64).astype(np.int64)
    flat = dims + np.arange(n)[:, None] * DIMENSIONS
    counts = np.bincount(flat.ravel(), minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    return counts.astype(np.int8 if length < 128 else np.int32)


def best_split(points: np.ndarray) -> tuple[int, int] | None:
    """(dimension, limit) that splits points into `count <= limit` and the rest most evenly."""
    n, best, found = len(points), 0, None
    top = int(points.max(initial=0))
    for limit in range(min(top, 8)):
        below = (points <= limit).sum(axis=0)
        even = np.minimum(below, n - below)
        k = int(even.argmax())
        if even[k] > best:
            best, found = int(even[k]), (k, limit)
    if found is None and top > 8:  # long words: halve the widest count
        spread = points.max(axis=0) - points.min(axis=0)
        k = int(spread.argmax())
        if spread[k]:
            return k, int((int(points[:, k].max()) + int(points[:, k].min())) // 2)
    return found


class Split:
    """A node of the tree; `left` and `right` are nodes or leaves (numbers)."""

    def __init__(self, dim: int, limit: int, left: object, right: object):
        self.dim, self.limit, self.left, self.right = dim, limit, left, right


def build_top(points: np.ndarray, most: float) -> tuple[object, int]:
    """Tree whose leaves hold at most `most` of the points where counts can split them."""
    leaves = 0

    def grow(part: np.ndarray) -> object:
        nonlocal leaves
        split = best_split(part) if len(part) > most else None
        if split is None:
            leaves += 1
            return leaves - 1
        below = part[:, split[0]] <= split[1]
        return Split(*split, grow(part[below]), grow(part[~below]))

    return grow(points), leaves


def reach(node: object, at: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray,
          box: dict | None = None) -> Iterator[tuple[object, np.ndarray]]:
    """Leaves with the queries that may have a partner there.

    `low` and `high`: by how much a query's counts may yet be too low or too high for the box;
    they go along with `at`, the numbers of the queries.
    """
    if not len(at):
        return
    if not isinstance(node, Split):
        yield node, at
        return
    box, dim, limit = box or {}, node.dim, node.limit
    least, most = box.get(dim, (None, None))
    count = counts[at, dim].astype(np.int32)
    spent = np.maximum(count - most, 0) if most is not None else 0
    left = high - (np.maximum(count - limit, 0) - spent)
    keep = left >= 0
    yield from reach(node.left, at[keep], counts, low[keep], left[keep],
                     {**box, dim: (least, limit)})
    spent = np.maximum(least - count, 0) if least is not None else 0
    left = low - (np.maximum(limit + 1 - count, 0) - spent)
    keep = left >= 0
    yield from reach(node.right, at[keep], counts, left[keep], high[keep],
                     {**box, dim: (limit + 1, most)})


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows that differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows where the longer word has exactly one letter more."""
    length = short.shape[1]
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= length


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _masked(codes: np.ndarray, delete: bool) -> np.ndarray:
    """Hash of each row without the letter at each place (masked, or deleted: the rest moves up)."""
    n, length = codes.shape
    power = np.cumprod(np.full(length + 1, _ODD, np.uint64))
    terms = (codes.astype(np.uint64) + np.uint64(1)) * power[:length]
    sums = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(terms, axis=1)], axis=1)
    before, after = sums[:, :-1], sums[:, -1:] - sums[:, 1:]
    if not delete:
        return before + after + power[1:]
    back = np.uint64(pow(int(_ODD), -1, 1 << 64))
    return before + after * back


def _whole(codes: np.ndarray) -> np.ndarray:
    power = np.cumprod(np.full(codes.shape[1], _ODD, np.uint64))
    return ((codes.astype(np.uint64) + np.uint64(1)) * power).sum(axis=1, dtype=np.uint64)


def _equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values in two arrays."""
    order = np.argsort(b, kind="stable")
    first = np.searchsorted(b[order], a, "left")
    count = np.searchsorted(b[order], a, "right") - first
    left = np.repeat(np.arange(len(a)), count)
    inside = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
    return left, order[np.repeat(first, count) + inside]


def dense_pairs(queries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs one edit apart in a large leaf, by joins of masked words; letters decide."""
    left, right = [], []
    if queries.shape[1] == points.shape[1]:
        a, b = _masked(queries, False), _masked(points, False)
        for k in range(queries.shape[1]):
            i, j = _equal(a[:, k], b[:, k])
            fits = one_replaced(queries[i], points[j])
            left.append(i[fits])
            right.append(j[fits])
    else:
        a, b = _whole(queries), _masked(points, True)
        for k in range(points.shape[1]):
            i, j = _equal(a, b[:, k])
            fits = one_inserted(queries[i], points[j])
            left.append(i[fits])
            right.append(j[fits])
    both = np.unique(np.concatenate(left) * len(points) + np.concatenate(right))
    return both // len(points), both % len(points)


def signatures(counts: np.ndarray) -> np.ndarray:
    """Two words of bits per row; one letter more or less changes one bit at most."""
    capped = np.minimum(counts[:, :26], 3)
    bits = np.zeros((len(counts), 128), np.uint8)
    for k in range(3):
        bits[:, k * 26:(k + 1) * 26] = capped > k
    bits[:, 78:128] = counts[:, 26:76] > 0
    return np.packbits(bits, axis=1).view(np.uint64)


def leaf_pairs(queries: np.ndarray, points: np.ndarray, query_bits: np.ndarray,
               point_bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs one edit apart: bits of the counts first, then letter order."""
    if len(queries) * len(points) > DENSE:
        return dense_pairs(queries, points)
    same = queries.shape[1] == points.shape[1]
    fits = one_replaced if same else one_inserted
    left, right = [], []
    step = max(1, TOGETHER // len(points))
    for at in range(0, len(queries), step):
        far = np.bitwise_count(query_bits[at:at + step, None, 0] ^ point_bits[None, :, 0])
        far += np.bitwise_count(query_bits[at:at + step, None, 1] ^ point_bits[None, :, 1])
        i, j = np.nonzero(far <= (2 if same else 1))
        good = fits(queries[i + at], points[j])
        left.append(i[good] + at)
        right.append(j[good])
    return np.concatenate(left), np.concatenate(right)


def near_pairs(query_words: list[str], point_words: list[str],
               length: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) numbers of all pairs one edit apart; points have `length` letters.

    Queries have as many letters or one less, all the same number.
    """
    shorter = len(query_words[0]) < length
    points, queries = letters(point_words, length), letters(query_words, length - shorter)
    counts, asked = vectors(points), vectors(queries)
    point_bits, query_bits = signatures(counts), signatures(asked)
    members: list[np.ndarray] = []

    def grow(part: np.ndarray) -> object:
        split = best_split(counts[part]) if len(part) > LEAF else None
        if split is None:
            members.append(part)
            return len(members) - 1
        below = counts[part, split[0]] <= split[1]
        return Split(*split, grow(part[below]), grow(part[~below]))

    tree = grow(np.arange(len(points)))
    n = len(queries)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    room = np.ones(n, np.int32)
    for leaf, at in reach(tree, np.arange(n), asked, room, room - shorter):
        part = members[leaf]
        i, j = leaf_pairs(queries[at], points[part], query_bits[at], point_bits[part])
        left.append(at[i])
        right.append(part[j])
    return np.concatenate(left), np.concatenate(right)


_ROUTED = "length int, cell int, kind int, word string, n long"
_PARTS = "word string, near long, best_n long, best_word string"


def _route(words: DataFrame, tops: dict[int, object]) -> DataFrame:
    """Every word to its cell, and as a query to the cells it can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = np.array(batch.column("word").to_pylist(), dtype=object)
            times = batch.column("n").to_numpy()
            sizes = np.array([len(t) for t in texts])
            for length in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == length)
                counts = vectors(letters(texts[own].tolist(), length))
                room, all_of = np.ones(len(own), np.int32), np.arange(len(own))
                tree, longer = tops.get(length, 0), tops.get(length + 1, 0)
                for kind, into, node, low, high in (
                        (POINT, length, tree, 0 * room, 0 * room), (SAME, length, tree, room, room),
                        (SHORTER, length + 1, longer, room, 0 * room)):
                    for cell, at in reach(node, all_of, counts, low, high):
                        k = len(at)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(k, into, np.int32)), pa.array(np.full(k, cell, np.int32)),
                            pa.array(np.full(k, kind, np.int32)),
                            pa.array(texts[own[at]].tolist(), pa.string()),
                            pa.array(times[own[at]], pa.int64())],
                            names=["length", "cell", "kind", "word", "n"])

    return words.select("word", "n").mapInArrow(run, _ROUTED)


def _search(key: tuple, group: pa.Table) -> pa.Table:
    """Near words of one cell: per word their number here and the best of them."""
    length = key[0].as_py()
    kinds = group.column("kind").to_numpy()
    words = group.column("word").to_pylist()
    times = group.column("n").to_numpy()
    points = np.flatnonzero(kinds == POINT)
    found = [np.empty((2, 0), np.int64)]
    for kind in (SAME, SHORTER):
        asked = np.flatnonzero(kinds == kind)
        if not len(points) or not len(asked):
            continue
        i, j = near_pairs([words[k] for k in asked], [words[k] for k in points], length)
        found.append(np.stack([asked[i], points[j]]))
        if kind == SHORTER:  # the longer word has the shorter one as its partner as well
            found.append(np.stack([points[j], asked[i]]))
    word, partner = np.concatenate(found, axis=1)
    order = sorted(set(partner.tolist()), key=lambda k: (-times[k], words[k]))
    rank = np.zeros(len(words), np.int64)
    rank[order] = np.arange(len(order))
    near = np.bincount(word, minlength=len(words))
    best = np.full(len(words), len(order), np.int64)
    np.minimum.at(best, word, rank[partner])
    named = np.flatnonzero(near)
    first = [order[k] for k in best[named]]
    return pa.table({
        "word": pa.array([words[k] for k in named], pa.string()),
        "near": pa.array(near[named], pa.int64()),
        "best_n": pa.array([int(times[k]) for k in first], pa.int64()),
        "best_word": pa.array([words[k] for k in first], pa.string())})


def _tops(words: DataFrame) -> dict[int, object]:
    """The top of the tree of every length that needs one, from a sample of the words."""
    total = words.count()
    sample = [r.word for r in
              words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).collect()]
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    share, tops = len(sample) / max(1, total), {}
    for length, some in by_length.items():
        most = share * max(64, CELL * 32 // max(32, length))
        top, leaves = build_top(vectors(letters(some, length)), most)
        if leaves > 1:
            tops[length] = top
    return tops


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """The last word of each chain of forms: word, root.

    Numbers at least double along a chain, so it has few links; each round doubles those covered.
    """
    jumps = durable(forms.select("word", F.col("form").alias("root")))
    for _ in range(largest.bit_length().bit_length() + 1):
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = durable(jumps.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")))
        if jumps.where("moved").isEmpty():
            break
        jumps = jumps.drop("moved")
    return jumps.select("word", "root")


def spelling_forms(words: DataFrame) -> DataFrame:
    """Spelling variants among distinct words with their numbers.

    Per row of `words` (word, n; other columns are ignored): word, form, root, n, n_near, form_n. Words
    are near if one code point is inserted, deleted or replaced; n_near is the number of near words. The
    form is the near word with the largest n (ties: the first in code point order) if that n is at least
    twice the word's own, else null, and form_n its n; the root is the last of the forms that follow
    each other, the word itself if there is none.

    Words that are null or without letters to compare (empty) have no near words; a repeated word counts
    once, with its largest n; an empty table gives no rows. A word of any length is compared whole.
    The sample of the tree's top (`SAMPLE` words) decides about the size of cells only.
    """
    words = durable(words.groupBy("word").agg(F.max("n").cast("long").alias("n")))
    real = words.where("length(word) > 0 and n is not null")
    parts = _route(real, _tops(real)).groupBy("length", "cell").applyInArrow(_search, _PARTS)
    near = parts.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best_word").alias("form")))
        .alias("best"))
    marked = durable(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best")).alias("best")))
    marked = marked.select("word", "n", "n_near", F.col("best.form").alias("form"),
                           (-F.col("best.less")).alias("form_n"))
    largest = marked.agg(F.max("n")).first()[0] or 0
    roots = _roots(marked.where("form is not null"), largest)
    return marked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
