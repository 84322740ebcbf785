"""Repeated passages removed with suffix automata of reference shards.

A window is `span` consecutive words. It has an anchor: the smallest hash among its word groups of
16, so equal windows have equal anchors and a document has one anchor in about 18 words.

1. Anchors that occur in two or more documents are found; the smallest such document owns them.
2. A window with a shared anchor is suspect. The owner's suspect windows are the reference, those of
   other documents are looked up there. Owners are dealt to shards of bounded size.
3. A task builds the suffix automaton of a shard and streams the passages of other documents
   through it; where the matching statistic reaches `span`, the words are covered. A shard that
   many documents ask for is sent to several tasks, each with a part of the documents.
4. A suspect window that its anchor's owner lacks is, for the same reason, missing there for every
   document that has it: these few are settled among themselves by their hashes.

A reference that grows with the corpus cannot be broadcast to every task, so a shard goes only to
the tasks that stream documents with its anchors. Windows are compared as 64-bit word hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.words import Words, drop_kept, slices, window_hashes
from studyloom.session import durable

SPAN, GROUP = 50, 16
#: Words of reference in one automaton, and of documents streamed through one copy of it.
SHARD_WORDS, STREAM_WORDS = 30_000, 300_000
#: A table of ids below this size may be sent to every executor.
SMALL_IDS = 4_000_000


class SuffixAutomaton:
    """All substrings of several word sequences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of q for the shorter strings that end in p + word."""
        following, link, length = self.next, self.link, self.length
        copy = self._state(length[p] + 1, link[q], dict(following[q]))
        while p >= 0 and following[p].get(word) == q:
            following[p][word] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, words: list[int]) -> None:
        following, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = following[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, word, q)
                continue
            new = self._state(length[last] + 1, 0, {})
            p = last
            while p >= 0 and word not in following[p]:
                following[p][word] = new
                p = link[p]
            if p >= 0:
                q = following[p][word]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
            last = new

    def statistics(self, words: list[int]) -> list[int]:
        """For each place, the length of the longest match that ends there."""
        following, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for word in words:
            to = following[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(word)
            if to is not None:
                state, matched = to, matched + 1
            out.append(matched)
        return out


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:]) if len(out) > done else out[:0]
        done *= 2
    rest = width - done
    return out if not rest else (
        np.minimum(out[:-rest], out[rest:]) if len(out) > rest else out[:0])


def _anchors(hashes: np.ndarray, span: int, group: int) -> np.ndarray:
    """The anchor of each window of `span` words, texts not told apart."""
    groups = window_hashes(hashes, group)
    return _smallest(groups, span - group + 1).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_key"), "text")


def _profiles(docs: DataFrame, span: int, group: int) -> DataFrame:
    """Per row: doc_id, text_key, n_words, sha256 of its words, distinct anchors."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                anchors = _anchors(words.hashes(), span, group)
                first = words.first
                own = [np.unique(anchors[a:max(a, b - span + 1)])
                       for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("text_key"),
                    pa.array(words.counts().astype(np.int64)),
                    pa.array([_digest(words, t, None) for t in range(len(own))], pa.string()),
                    pa.array(own, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_words", "sha", "anchors"])

    return _texts(docs).mapInArrow(
        profile, "doc_id long, text_key long, n_words long, sha string, anchors array<long>")


def _digest(words: Words, text: int, keep: np.ndarray | None) -> str:
    """sha256 of the kept words of a text, joined by one space."""
    a, b = words.first[text], words.first[text + 1]
    raw = words.data[words.begin[text]:words.begin[text + 1]].tobytes()
    if keep is None:
        parts = raw.split()  # the six separators, as the words of bytes
    else:
        at = words.begin[text]
        start, end = words.start[a:b][keep] - at, words.end[a:b][keep] - at
        parts = [raw[x:y] for x, y in zip(start.tolist(), end.tolist())]
    return hashlib.sha256(b" ".join(parts)).hexdigest()


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (first, last) of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


_PASSAGES = ("owner long, is_reference boolean, doc_id long, text_key long, start int, "
             "n_words int, words binary")


def _passages(docs: DataFrame, owned: DataFrame, span: int, group: int) -> DataFrame:
    """Suspect passages: runs of windows whose anchors have the same owner."""
    names = [c.split()[0] for c in _PASSAGES.split(", ")]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                hashes = words.hashes()
                anchors = _anchors(hashes, span, group)
                rows = []
                for t, (doc_id, key, shared) in enumerate(zip(*(
                        part.column(c).to_pylist() for c in ("doc_id", "text_key", "shared")))):
                    a, b = words.first[t], words.first[t + 1]
                    if b - a < span:
                        continue
                    own = anchors[a:b - span + 1]
                    table = np.array([s["anchor"] for s in shared], dtype=np.int64)
                    owners = np.array([s["owner"] for s in shared], dtype=np.int64)
                    order = np.argsort(table)
                    table, owners = table[order], owners[order]
                    at = np.minimum(np.searchsorted(table, own), len(table) - 1)
                    suspect, owner = table[at] == own, owners[at]
                    for first, last in _runs(suspect):
                        turn = np.flatnonzero(np.diff(owner[first:last + 1])) + first + 1
                        for x, y in zip([first, *turn.tolist()], [*turn.tolist(), last + 1]):
                            passage = hashes[a + x:a + y - 1 + span]
                            rows.append((int(owner[x]), bool(owner[x] == doc_id), doc_id, key,
                                         x, len(passage), passage.tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return _of(docs, owned).join(owned, ["doc_id", "text_key"]).select(
        "doc_id", "text_key", "text", "shared").mapInArrow(cut, _PASSAGES)


def _of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Texts of the documents in `keys`; few ids are sent to the texts, many are shuffled."""
    ids = keys.select("doc_id").distinct()
    if keys.count() <= SMALL_IDS:
        ids = F.broadcast(ids)
    return _texts(docs).join(ids, "doc_id", "left_semi")


_MATCHES = ("doc_id long, text_key long, firsts array<int>, lasts array<int>, "
            "places array<int>, hashes array<long>")


def _match(passages: DataFrame, span: int) -> DataFrame:
    """Per streamed passage: covered spans, and its windows that the owner lacks."""
    count = int(passages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = F.col("n_words").cast("long")
    total = passages.filter("is_reference").agg(F.sum(words)).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = passages.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)))
    asked = dealt.filter("not is_reference").groupBy("shard").agg(
        F.ceil(F.sum(words) / STREAM_WORDS).alias("parts")).filter("parts > 1")
    spread = dealt.join(asked, "shard", "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.explode(F.when(
            F.col("is_reference"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("doc_id", "start"), F.col("parts"))))))
    types = [pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.int64())]
    names = ["doc_id", "text_key", "firsts", "lasts", "places", "hashes"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        current, automaton = None, SuffixAutomaton()
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                key = (row["shard"], row["part"])
                if key != current:
                    current, automaton = key, SuffixAutomaton()
                passage = np.frombuffer(row["words"], np.uint64)
                if row["is_reference"]:
                    automaton.add(passage.tolist())
                    continue
                reach = np.array(automaton.statistics(passage.tolist()))
                hit = reach[span - 1:] >= span  # by the window's first word
                spans = _runs(hit)
                missed = np.flatnonzero(~hit)
                hashes = window_hashes(passage, span)[missed].view(np.int64)
                start = row["start"]
                rows.append((row["doc_id"], row["text_key"], [start + a for a, _ in spans],
                             [start + b + span - 1 for _, b in spans], start + missed, hashes))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    return (spread.repartition(count, "shard", "part")
            .sortWithinPartitions("shard", "part", F.desc("is_reference"), "doc_id", "start")
            .select("shard", "part", "is_reference", "doc_id", "text_key", "start", "words")
            .mapInArrow(stream, _MATCHES))


def remove_repeats(docs: DataFrame, span: int = SPAN, group: int = GROUP) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed, kept_sha256, removed.

    A word is removed if a window of `span` words covers it whose words also stand in a document
    with a smaller doc_id. `removed` lists the removed stretches (first, last word from 0), null if
    there are none. kept_sha256 is that of the kept words joined by one space. Needs doc_id and text;
    other columns are ignored. Null text has no words. Rows of one doc_id are one document, they
    do not repeat each other. A row without a doc_id keeps all its words and is no one's repeat.
    Texts shorter than a window stay as they are; an empty table gives no rows.
    """
    profiles = durable(_profiles(docs, span, group))
    anchors = profiles.filter("doc_id is not null").select(
        "doc_id", "text_key", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("other")).filter(
        "owner < other").select("anchor", "owner")
    owned = durable(anchors.join(shared, "anchor").groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("anchor", "owner")).alias("shared")))
    passages = durable(_passages(docs, owned, span, group))
    matched = durable(_match(passages, span))

    rest = matched.select("doc_id", "text_key", F.explode(F.arrays_zip("places", "hashes"))
                          .alias("w")).select("doc_id", "text_key", "w.places", "w.hashes")
    first = rest.groupBy("hashes").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("other")).filter("owner < other")
    late = rest.join(first, "hashes").filter("doc_id > owner").select(
        "doc_id", "text_key", F.col("places").alias("first"),
        (F.col("places") + F.lit(span - 1)).alias("last"))
    found = matched.select("doc_id", "text_key", F.explode(F.arrays_zip("firsts", "lasts"))
                           .alias("s")).select("doc_id", "text_key",
                                               F.col("s.firsts").alias("first"),
                                               F.col("s.lasts").alias("last"))
    spans = durable(found.unionByName(late).groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("first", "last")).alias("spans")))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                counts = words.counts()
                gone, digests, removed = [], [], []
                for t, stretches in enumerate(part.column("spans").to_pylist()):
                    change = np.zeros(int(counts[t]) + 1, dtype=np.int64)
                    np.add.at(change, [s["first"] for s in stretches], 1)
                    np.add.at(change, [s["last"] + 1 for s in stretches], -1)
                    out = np.cumsum(change)[:-1] > 0
                    gone.append(int(out.sum()))
                    digests.append(_digest(words, t, ~out))
                    removed.append([{"first": a, "last": b} for a, b in _runs(out)])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(counts.astype(np.int64)),
                    pa.array(gone, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(removed, pa.list_(pa.struct([("first", pa.int32()),
                                                          ("last", pa.int32())])))],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])

    changed = _of(docs, spans).join(spans, ["doc_id", "text_key"]).select(
        "doc_id", "text", "spans").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, "
                "removed array<struct<first: int, last: int>>")
    whole = profiles.join(spans, ["doc_id", "text_key"], "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
        F.col("sha").alias("kept_sha256"),
        F.lit(None).cast("array<struct<first: int, last: int>>").alias("removed"))
    return whole.unionByName(changed)
