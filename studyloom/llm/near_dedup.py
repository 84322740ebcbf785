"""Near duplicates by HyperMinHash registers, banding, estimates and a check on full sets.

1. A text's shingle hashes fall into 128 buckets. A bucket keeps, of its smallest hash, the
   number of leading zeros and ten bits of mantissa, 16 bits in all. Four registers make a band, 32
   bands a signature. Sets too small for 128 buckets are hashed anew in several rounds of fewer buckets
   each, so that bands have no empty registers to agree by: else two small texts with one line in
   common, or none, would share bands, and their number grows with the square of the table.
2. Texts with equal shingle sets become one node. Nodes that share a band value, and whose set sizes
   allow the similarity (the same or neighbouring size class), are candidates. The larger class of
   a pair says how many rounds there are; a node has bands for its own class and for the next. A
   pair of similarity 0.75 shares none of 32 bands with a chance of 5 in a million.
3. Candidates are dealt to blocks of bounded size: a node's home is the smallest node of the largest
   group with a band value of its own, a large home is cut by hash. Two blocks meet if they share a band value, and
   only nodes that do take part. A task holds two blocks at most, whatever the size of a group of
   copies, and a node's full set travels once per block it meets.
4. Where blocks meet, registers give collision-corrected estimates, which order the pairs; every pair
   whose sizes allow the similarity is confirmed on full sets, best first, but not if links found there
   connect them already. So at most one link per node comes out, and no pair that could change a
   component is skipped, whatever its estimate.
5. Components of the links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.components import components
from studyloom.llm.words import drop_kept, mix, shingle_sets, slices
from studyloom.session import durable

SHINGLE = 5
BUCKET_BITS, MANTISSA_BITS, BAND = 7, 10, 4
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // BAND
EMPTY = 0xFFFF
_NO_BAND = np.uint64((1 << 64) - 1)
_BANDS = np.arange(BANDS, dtype=np.uint64)
_ROUND = np.uint64(0xD1342543DE82EF95)
#: Least shingles per bucket, on average, where sets are hashed in rounds.
FILL = 3
#: Chance that two unequal smallest hashes of a bucket get the same register.
COLLISION = 2.0 ** -MANTISSA_BITS / 3
#: Standard deviations below the threshold down to which pairs are taken best first.
DOUBT = 5.0
BLOCK_NODES, BLOCK_SHINGLES = 2048, 1_500_000
#: A table of ids below this size may be sent to every executor.
SMALL_IDS = 4_000_000


def registers(shingles: np.ndarray) -> np.ndarray:
    """128 registers of a sorted set of 64-bit hashes."""
    out = np.full(BUCKETS, EMPTY, dtype=np.uint16)
    if len(shingles):
        bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rest = shingles[first] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)
        high = (rest >> np.uint64(MANTISSA_BITS)).astype(np.float64)
        length = np.frexp(high)[1].astype(np.int64)  # bits of the upper part
        zeros = 64 - BUCKET_BITS - MANTISSA_BITS - length
        mantissa = (rest >> np.maximum(length - 1, 0).astype(np.uint64)).astype(np.int64) & (
            (1 << MANTISSA_BITS) - 1)
        out[bucket[first]] = (zeros << MANTISSA_BITS | mantissa).astype(np.uint16)
    return out


def estimates(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of a signature to others, corrected for accidental agreement; buckets used."""
    filled = (many != EMPTY) | (one != EMPTY)
    used = np.maximum(filled.sum(axis=1), 1)
    share = ((many == one) & filled).sum(axis=1) / used
    return (share - COLLISION) / (1 - COLLISION), used


def size_class(n: int, threshold: int) -> int:
    """Sets of a similarity of the threshold have the same size class or neighbours."""
    return math.floor(math.log(n) / math.log(1.0001 * 100 / threshold))


def rounds(size: int, threshold: int) -> int:
    """How many times sets of a size class are hashed: 1, 2, 4, ... 128; 128 buckets in all."""
    least = math.exp(size * math.log(1.0001 * 100 / threshold))
    return BUCKETS >> min(BUCKET_BITS, max(0, math.floor(math.log2(max(least / FILL, 1)))))


def in_rounds(shingles: np.ndarray, times: int) -> np.ndarray:
    """Hashes for `registers`: those of round r fall into the r-th of `times` parts of the buckets."""
    if times == 1 or not len(shingles):
        return shingles
    number = np.arange(times, dtype=np.uint64)[:, None]
    again = mix(shingles[None, :] + (number + np.uint64(1)) * _ROUND)
    part = np.uint64(times.bit_length() - 1)
    return np.sort((number << (np.uint64(64) - part) | again >> part).ravel())


def bands(shingles: np.ndarray, threshold: int) -> tuple[int, np.ndarray]:
    """Size class and band hashes, -1 for a band of empty registers. The first 32 hold for the class
    itself and, if there are no more, for the next class; else the other 32 do."""
    size = size_class(len(shingles), threshold)
    parts = []
    for times in dict.fromkeys((rounds(size, threshold), rounds(size + 1, threshold))):
        # the registers of a band come from different rounds
        value = registers(in_rounds(shingles, times)).reshape(times, -1).T.ravel().view(np.uint64)
        parts.append(np.where(value == _NO_BAND, _NO_BAND, mix(
            value ^ mix(_BANDS + np.uint64(times << 16)))))
    return size, np.concatenate(parts).view(np.int64)


def signatures(docs: DataFrame, threshold: int = 75, size: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, n_shingles, set_digest (128 bits, hex), size_class, bands (null if empty)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), size)
                signed = [bands(s, threshold) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest()
                              if len(s) else None for s in sets], pa.string()),
                    pa.array([c for c, _ in signed], pa.int32()),
                    pa.array([b for _, b in signed], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_digest", "size_class", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_digest string, size_class int, bands array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(node, shingles as sorted 8-byte hashes) of the documents in `nodes`."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array([s.tobytes() for s in shingle_sets(part.column("text"), size)],
                              pa.binary())], names=["node", "shingles"])

    ids = nodes.select(F.col("node").alias("doc_id"))
    if nodes.count() <= SMALL_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        collect, "node long, shingles binary")


def _block_links(nodes: list[int], sets: list[np.ndarray], side: np.ndarray,
                 threshold: int) -> list[tuple[int, int]]:
    """Links that connect the nodes of two meeting blocks (or of one, if all are of one side).

    Pairs with a promising estimate come first, best first; then every other pair whose sizes allow
    the similarity and that is not connected yet is checked on full sets, one node against many.
    """
    n = len(nodes)
    signs = np.array([registers(s) for s in sets])
    lengths = np.array([len(s) for s in sets])
    one_block = bool((side == side[0]).all())

    def allowed(i: int) -> np.ndarray:
        """Later nodes that node i is to be compared with and whose size fits."""
        fits = np.minimum(lengths[i + 1:], lengths[i]) * 100 >= threshold * np.maximum(
            lengths[i + 1:], lengths[i])
        return fits if one_block else fits & (side[i + 1:] != side[i])

    left, right, guess = [], [], []
    for i in range(n - 1):
        estimate, used = estimates(signs[i], signs[i + 1:])
        likely = estimate >= threshold / 100 - DOUBT * np.sqrt(0.1875 / used)
        found = np.flatnonzero(likely & allowed(i))
        left.append(np.full(len(found), i))
        right.append(found + i + 1)
        guess.append(estimate[found])
    group = np.arange(n)
    links = []

    def similar(i: int, j: np.ndarray | int, both: np.ndarray | int) -> np.ndarray | bool:
        return 100 * both >= threshold * (lengths[i] + lengths[j] - both)

    def link(i: int, j: int) -> None:
        group[group == group[j]] = group[i]
        links.append((nodes[i], nodes[j]))

    if left:
        left, right, guess = map(np.concatenate, (left, right, guess))
        for k in np.argsort(-guess, kind="stable").tolist():
            i, j = int(left[k]), int(right[k])
            if group[i] != group[j] and similar(
                    i, j, len(np.intersect1d(sets[i], sets[j], assume_unique=True))):
                link(i, j)
    if (group == group[0]).all():
        return links
    every, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(lengths)
    ids = [ids[e - k:e] for e, k in zip(ends.tolist(), lengths.tolist())]
    present = np.zeros(len(every), dtype=bool)
    for i in range(n - 1):
        rest = np.flatnonzero(allowed(i) & (group[i + 1:] != group[i])) + i + 1
        if not len(rest):
            continue
        present[ids[i]] = True
        starts = np.concatenate([[0], np.cumsum(lengths[rest])[:-1]])
        both = np.add.reduceat(
            present[np.concatenate([ids[j] for j in rest])].astype(np.int64), starts)
        present[ids[i]] = False
        for j in rest[similar(i, rest, both)].tolist():
            if group[i] != group[j]:
                link(i, j)
    return links


def _meetings(candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """(group columns, node, side): which nodes of which two blocks have to be compared."""
    # the largest group of a node decides: its members stay together, and small groups meet few blocks
    homes = candidates.groupBy("node").agg(
        F.max(F.struct("n", (-F.col("leader")).alias("back"))).alias("most")).select(
        "node", (-F.col("most.back")).alias("home")).join(sizes, "node")
    cuts = homes.groupBy("home").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES),
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("cuts"))
    blocks = durable(homes.join(cuts, "home").select("node", F.struct(
        "home", F.pmod(F.xxhash64("node"), F.col("cuts")).alias("cut")).alias("block")))
    placed = candidates.select("key", "node").join(blocks, "node")
    by_key = placed.groupBy("key", "block").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.collect_list(F.struct("block", "n")).alias("there"))
    # a node meets its own block only if another node of it shares the value
    others = F.transform(F.filter("there", lambda x: (x["block"] != F.col("block")) | (x["n"] > 1)),
                         lambda x: x["block"])
    met = placed.join(by_key, "key").select("node", "block", others.alias("others")).groupBy(
        "node").agg(F.first("block").alias("block"),
                    F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    return met.select("node", "block", F.explode("others").alias("other")).select(
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node",
        (F.col("block") <= F.col("other")).cast("int").alias("side"))


def band_groups(signed: DataFrame) -> DataFrame:
    """(key, node, n_shingles): which nodes share a band value and fit in size, with those of a key
    that have no other node yet."""
    reps = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_digest").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
        F.first("size_class").alias("size_class"), F.first("bands").alias("bands"))
    own, later = F.col("size_class"), F.col("size_class") + 1
    members = reps.select("node", "n_shingles", "size_class", F.size("bands").alias("bands"),
                          F.posexplode("bands").alias("at", "group")) \
        .filter("group <> -1")  # a band of empty registers
    shared = members.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # similar sets have similar sizes: their size classes are the same or neighbours
    classes = F.when(F.col("bands") == BANDS, F.array(own, later)).when(
        F.col("at") < BANDS, F.array(own)).otherwise(F.array(later))
    sized = members.join(shared.select("group"), "group").select(
        "group", "node", "n_shingles", F.explode(classes).alias("class"))
    return sized.select(F.xxhash64("group", "class").alias("key"), "node", "n_shingles")


def near_links(docs: DataFrame, signed: DataFrame, threshold: int = 75,
               size: int = SHINGLE) -> DataFrame:
    """Links (a, b) between documents with different shingle sets that connect every component."""
    sized = durable(band_groups(signed))
    groups_of = sized.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).filter("n > 1")
    candidates = durable(sized.join(groups_of, "key"))
    sizes = durable(candidates.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")))
    groups = _meetings(candidates, sizes)
    sets = full_sets(docs, sizes, size)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        def out(nodes, sets_, sides) -> pa.RecordBatch:
            links = _block_links(nodes, sets_, np.array(sides), threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.int64()),
                 pa.array([x for _, x in links], pa.int64())], names=["a", "b"])

        current, nodes, held, sides = None, [], [], []
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("h1", "c1", "h2", "c2")]))
            values = batch.column("shingles")
            for k, (key, node, side) in enumerate(zip(
                    keys, batch.column("node").to_pylist(), batch.column("side").to_pylist())):
                if key != current:
                    if len(nodes) > 1:
                        yield out(nodes, held, sides)
                    current, nodes, held, sides = key, [], [], []
                nodes.append(node)
                held.append(np.frombuffer(values[k].as_py(), np.uint64))
                sides.append(side)
        if len(nodes) > 1:
            yield out(nodes, held, sides)

    flat = groups.select(
        F.col("one.home").alias("h1"), F.col("one.cut").alias("c1"), F.col("two.home").alias("h2"),
        F.col("two.cut").alias("c2"), "node", "side")
    full = flat.join(sets, "node")
    count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (full.repartition(count, "h1", "c1", "h2", "c2")
            .sortWithinPartitions("h1", "c1", "h2", "c2", "node")
            .mapInArrow(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, threshold: int = 75, size: int = SHINGLE) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= threshold * union of their sets of
    `size`-word shingles (A-Z lower-cased). component_id is the smallest doc_id that can be reached;
    kept says doc_id = component_id. A text without words, or null, is linked with nothing. Rows
    of one doc_id are one document. A row without a doc_id is linked with nothing, has a null
    component_id and is kept. An empty table gives no rows; other columns are ignored.
    """
    signed = durable(signatures(docs, threshold, size))
    links = durable(near_links(docs, signed, threshold, size))
    copies = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_digest").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n"))
    same = signed.join(copies.filter("n > 1"), "set_digest").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(links.unionByName(same))
    return (signed.join(found, signed["doc_id"] == found["node"], "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one_of_each(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """The rows of `docs` without those that `near_duplicates` does not keep.

    Rows of one doc_id stay or go together; rows without a doc_id, and null or empty texts, stay; all
    columns stay as they are; an empty table gives no rows. Texts are compared whole.
    """
    dropped = near_duplicates(docs, threshold).filter("not kept").select(
        F.col("doc_id").alias("_near_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["_near_dropped"], "left_anti")
