"""Operators on documents against brute force, with nulls, ties, repeats and empty tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from studyloom.llm.exact_dedup import DigestIndex, deduplicate, keep_distinct
from studyloom.llm.mixing import mix, repeat_rows, sainte_lague
from studyloom.llm.near_dedup import keep_one_of_each, near_duplicates
from studyloom.llm.substring_dedup import SuffixAutomaton, remove_repeats
from studyloom.llm.words import Words, shingle_sets

SCHEMA = "doc_id long, text string, lang string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(row):
    return tuple((v is None, v) for v in row)


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB é中\n\t ", max_size=15)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    import pyarrow as pa

    words = Words(pa.array(texts, pa.string()))
    raw = words.data.tobytes()
    found = [[raw[words.start[i]:words.end[i]].decode() for i in range(a, b)]
             for a, b in zip(words.first[:-1], words.first[1:])]
    assert found == [WORD.findall(t or "") for t in texts]
    pairs = dict(zip(sum(found, []), words.hashes().tolist()))
    assert [pairs[w] for w in sum(found, [])] == words.hashes().tolist()


def test_long_words_hash_like_short_ones():
    import pyarrow as pa

    word = "x" * 700_000
    h = Words(pa.array([f"{word} y {word} {word[1:]}"])).hashes()
    assert h[0] == h[2] != h[3]


def test_exact_dedup(docs, rows, spark):
    norm = [(i, (t or "").translate(LOWER)) for i, t, _, _ in rows]
    groups = collections.defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    got = deduplicate(docs, DigestIndex(spark, buckets=3)).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for sha, ids in by_sha.items():
        mine = [r for r in got if r.text_sha256 == sha]
        known = [i for i in ids if i is not None]
        assert collections.Counter(r.doc_id for r in mine) == collections.Counter(ids)
        assert {(r.keep_id, r.group_size) for r in mine} == {
            (max(known) if known else None, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [max(known) if known else None]


def test_digest_index_stops_later_batches(docs, no_docs, spark):
    index = DigestIndex(spark, buckets=2)
    first = deduplicate(docs, index).filter("kept").count()
    assert index.read().count() == first
    again = deduplicate(docs, index).collect()
    assert not any(r.kept for r in again) and index.read().count() == first
    more = spark.createDataFrame([(900, "brand new", "en", "a"), (901, "TWO WORDS", "en", "a")],
                                 docs.select("doc_id", "text", "lang", "source").schema)
    kept = {r.doc_id: (r.keep_id, r.kept) for r in deduplicate(more, index).collect()}
    assert kept == {900: (900, True), 901: (12, False)}
    assert index.read().count() == first + 1
    assert deduplicate(no_docs, index).count() == 0


def test_first_batch_is_joined_with_the_index(docs, spark, monkeypatch):
    index, joins = DigestIndex(spark, buckets=3), []
    frame = type(docs)
    join = frame.join

    def seen(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if index.table in other._jdf.queryExecution().analyzed().toString():
            joins.append((how, out._jdf.queryExecution().sparkPlan().toString()))
        return out

    monkeypatch.setattr(frame, "join", seen)
    deduplicate(docs, index).collect()
    assert [how for how, _ in joins] == ["left_anti", None]
    assert all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for _, plan in joins)
    held = {r.digest: r.keep_id for r in index.read().collect()}
    monkeypatch.undo()
    assert all(r.keep_id == held[r.text_sha256] and not r.kept
               for r in deduplicate(docs, index).collect())


def test_keep_distinct_keeps_one_row_per_text(docs, rows, spark):
    kept = keep_distinct(docs, DigestIndex(spark))
    assert kept.columns == docs.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t, _, _ in rows})


def components_of(rows):
    sets = {}
    for i, t, _, _ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in sets if i is not None}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return sets, {i: top(i) for i in root}


def test_near_duplicates(docs, rows):
    sets, root = components_of(rows)
    found = near_duplicates(docs)
    expected = []
    for i, t, _, _ in rows:
        n = len(sets[i]) if i is not None else len(components_of([(0, t, "", "")])[0][0])
        expected.append((i, n, root.get(i), True if i is None else root[i] == i))
    same(found, expected)
    assert max(collections.Counter(root.values()).values()) > 20


def test_near_duplicates_stage_keeps_one_of_each(docs, rows):
    _, root = components_of(rows)
    kept = [r.doc_id for r in keep_one_of_each(docs).collect()]
    assert sorted(i for i in kept if i is not None) == sorted(
        i for i, _, _, _ in rows if i is not None and root[i] == i)


def test_small_blocks_give_the_same_components(docs, rows, monkeypatch):
    from studyloom.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 3)
    monkeypatch.setattr(near_dedup, "SMALL_IDS", 0)
    _, root = components_of(rows)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect() if r.doc_id is not None}
    assert got == root


def test_registers_estimate_similarity():
    from studyloom.llm.near_dedup import estimates, registers

    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate([a[::2], rng.integers(0, 1 << 63, 2000, dtype=np.uint64)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    guess, used = estimates(registers(a), np.array([registers(b)]))
    assert abs(guess[0] - true) < 0.15 and used[0] == 128
    assert estimates(registers(a), np.array([registers(a)]))[0][0] == 1.0


def removal(rows, span):
    words = [(i, WORD.findall(t or "")) for i, t, _, _ in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - span + 1):
                g = tuple(w[k:k + span])
                first[g] = min(i, first.get(g, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - span + 1 if i is not None else 0):
            if first[tuple(w[k:k + span])] < i:
                gone[k:k + span] = [True] * span
        text = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_repeated_passages(docs, rows):
    same(remove_repeats(docs).drop("removed"), removal(rows, 50))


def test_repeated_passages_small_shards(docs, rows, monkeypatch):
    from studyloom.llm import substring_dedup

    for name in ("SHARD_WORDS", "STREAM_WORDS"):
        monkeypatch.setattr(substring_dedup, name, 60)
    monkeypatch.setattr(substring_dedup, "SMALL_IDS", 0)
    found = remove_repeats(docs, span=20, group=7)
    same(found.drop("removed"), removal(rows, 20))
    for r in found.collect():
        assert sum(s["last"] - s["first"] + 1 for s in r.removed or []) == r.n_removed


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=4),
       st.lists(st.integers(0, 2), max_size=12))
def test_matching_statistics(reference, words):
    automaton = SuffixAutomaton()
    for r in reference:
        automaton.add(r)
    known = {tuple(r[a:b]) for r in reference for a in range(len(r)) for b in range(a + 1, len(r) + 1)}
    expected = [max((n for n in range(1, e + 1) if tuple(words[e - n:e]) in known), default=0)
                for e in range(1, len(words) + 1)]
    assert automaton.statistics(words) == expected


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=7), st.integers(0, 40))
def test_highest_quotients(votes, seats):
    order = sorted((-(v / (2 * k + 1)), i) for i, v in enumerate(votes) for k in range(seats) if v)
    expected = collections.Counter(i for _, i in order[:seats])
    assert sainte_lague(np.array(votes), seats).tolist() == [expected[i] for i in range(len(votes))]


def test_mix(docs, rows):
    got = mix(docs, [3, 1, 2]).toPandas()
    size = collections.Counter()
    for _, t, _, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted(s for s in size if s is not None) + [None]
    target, open_ = {}, {s: [3, 1, 2][k % 3] for k, s in enumerate(order)}
    rest = 1.5 * sum(size.values())
    while open_:
        level = rest / sum(open_.values())
        full = [s for s, w in open_.items() if level * w >= 2 * size[s]]
        for s in full or list(open_):
            target[s] = 2 * size[s] if full else level * open_[s]
            rest -= target[s]
            del open_[s]
    names = got.assign(source=got.source.where(got.source.notna(), None))
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    for s, g in names.groupby("source", dropna=False):
        s = None if s is None or s != s else s
        assert g.source_size.iloc[0] == size[s]
        assert g.target.iloc[0] == pytest.approx(target[s])
        assert abs(g.taken.sum() - target[s]) <= 130


def test_mix_does_not_depend_on_partitions(docs):
    a = sorted(map(tuple, mix(docs, [3, 1, 2]).collect()), key=key)
    b = sorted(map(tuple, mix(docs.repartition(2), [3, 1, 2]).collect()), key=key)
    assert a == b


def test_repeat_rows(docs):
    taken = mix(docs, [3, 1, 2])
    out = repeat_rows(docs, taken)
    assert out.columns == docs.columns
    counts = collections.Counter(r.doc_id for r in out.collect())
    for r in taken.collect():
        if r.doc_id is not None and r.doc_id != 15 and r["size"]:
            assert counts[r.doc_id] == int(r.taken / r["size"] + 0.5)


def test_mixing_stage_meets_the_targets(spark):
    from corpus_pipeline import mixture
    from studyloom.llm.mixing import source_targets, word_counts

    rows = []
    for source, length, n in (("a", 40, 60), ("b", 900, 40), ("c", 130, 50), ("d", 300, 60)):
        rows += [(len(rows) + k, f"{source}{k} " + "w " * (length + k), "en", source)
                 for k in range(n)]
    rows += [(None, "no id", "en", "a"), (9000, "", "en", "a"), (9001, None, "en", "d")]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = mixture(spark, frame, "")
    assert out.columns == frame.columns
    words, copies = collections.Counter(), collections.Counter()
    for row in out.collect():
        words[row.source] += len(WORD.findall(row.text or ""))
        copies[row.doc_id] += 1
    assert max(copies.values()) <= 2 and copies[9000] == copies[9001] == 1
    longest = {"a": 101, "b": 940, "c": 180, "d": 360}
    for r in source_targets(word_counts(frame), [3, 1, 2], 1.5, 2.0).collect():
        # half a document and the rounding to blocks
        assert abs(words[r.source] - r.target) <= longest[r.source] / 2 + 64, r


@pytest.mark.parametrize("shard_words", [50, 2_000_000])
def test_small_sources_meet_their_targets(spark, shard_words):
    rows = [(k, "w " * n, "en", f"s{k:02d}")
            for k, n in enumerate((10, 15, 40, 100, 130, 33, 64, 65, 1))]
    rows += [(100 + k, "w " * (k % 9), "en", "x") for k in range(300)]
    got = mix(spark.createDataFrame(rows, SCHEMA), [1], shard_words=shard_words).toPandas()
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    for source, g in got.groupby("source"):
        assert g.taken.sum() == int(g.target.iloc[0] + 0.5), source
    assert got[got.source == "s00"].taken.sum() == 20


def test_rows_count_for_shards_and_empty_rows_are_in_none(spark, monkeypatch):
    from studyloom.llm import mixing

    words, rows = np.array([10, 4000, 0]), np.array([10, 4000, 0])
    assert mixing.shard_numbers(words, rows, 5000, 100).tolist() == [1, 40, 1]
    many = [(None if k % 2 else k, None if k % 3 else " ", "en", "a") for k in range(400)]
    frame = spark.createDataFrame([(1000 + k, "w w", "en", "a") for k in range(50)] + many, SCHEMA)
    placed = mixing._placed(mixing.word_counts(frame), [1], 1.5, 2.0, 17, 64, 10_000, 10).collect()
    assert len({r.shard for r in placed if r["size"]}) > 2
    assert len(placed) == 450 and all((r.quota is None) == (r["size"] == 0) for r in placed)
    got = mix(frame, [1]).toPandas()
    assert len(got) == 450 and got.taken.sum() == 150
    assert (got[got["size"] == 0].taken == 0).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=8), st.floats(0, 2),
       st.integers(0, 60))
def test_shard_quotas_come_to_the_words(sizes, ratio, blocks):
    from studyloom.llm.mixing import shard_quotas, taken_up_to

    words = int(ratio * sum(sizes))
    quota = shard_quotas(np.array(sizes), blocks, words, 64, 2)
    assert quota.sum() == words and (quota >= 0).all() and (quota <= 2 * np.array(sizes)).all()
    for size, q in zip(sizes, quota.tolist()):
        taken = np.diff(taken_up_to(np.arange(size + 1), q, 64, [1, 2, 3]))
        assert taken.sum() == q and np.ptp(taken) <= 1


def test_rows_without_ids_are_mixed_by_their_text(spark):
    from studyloom.llm.mixing import mix_whole

    rows = [(None if k % 2 else 7, f"t{k} " + "w " * 63, "en", "ab"[k % 4 < 2])
            for k in range(80)]
    out = mix_whole(spark.createDataFrame(rows, SCHEMA), [1, 3], share=0.5)
    counts = collections.Counter((r.source, r.text) for r in out.collect())
    by_source = collections.Counter(s for s, _ in counts.elements())
    assert max(counts.values()) == 1 and by_source == {"a": 10, "b": 30}


@pytest.mark.parametrize("sizes, quota, words", [
    ([5, 1000, 5, 5], 12, 10), ([1000, 5, 5, 5], 1015, 1015), ([7] * 10, 72, 70),
    ([10, 10], 16, 20), ([10, 10], 14, 10), ([3, 4, 5], 24, 24), ([3, 4, 5], 99, 24), ([], 5, 0)])
def test_whole_copies(sizes, quota, words):
    from studyloom.llm.mixing import whole_copies

    copies = whole_copies(np.array(sizes, dtype=np.int64), quota, 2)
    assert int((copies * np.array(sizes, dtype=np.int64)).sum()) == words
    assert copies.max(initial=0) <= 2 and (not len(copies) or np.ptp(copies) <= 1)


def test_empty_tables(no_docs, spark):
    assert deduplicate(no_docs, DigestIndex(spark)).count() == 0
    assert near_duplicates(no_docs).count() == 0
    assert remove_repeats(no_docs).count() == 0
    assert mix(no_docs, [1, 2]).count() == 0


def test_no_pair_is_lost_after_the_bands():
    """Pairs just above the threshold, thousands of them: all are linked, below it none."""
    from studyloom.llm.near_dedup import _block_links

    rng = np.random.default_rng(4)
    nodes, sets, want = [], [], set()
    for k in range(2500):
        n = int(rng.integers(4, 400))
        # largest similarity below or least one from 75 % to 80 %, by shared shingles
        both = int(rng.integers(-(-3 * n // 4), max(-(-3 * n // 4), 4 * n // 5) + 1)) - (k % 5 == 0)
        every = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        if len(every) < n:
            continue
        one = (n - both) // 2
        pair = np.sort(every[:both + one]), np.sort(np.concatenate([every[:both], every[both + one:]]))
        if not min(map(len, pair)):
            continue
        sets += pair
        nodes += [2 * k, 2 * k + 1]
        if 100 * both >= 75 * n:
            want.add((2 * k, 2 * k + 1))
    got = set()
    for at in range(0, len(nodes), 200):
        side = np.arange(len(nodes[at:at + 200])) % 2
        got |= set(_block_links(nodes[at:at + 200], sets[at:at + 200], side, 75))
        assert set(_block_links(nodes[at:at + 200], sets[at:at + 200], side * 0, 75)) == {
            p for p in want if p[0] in nodes[at:at + 200]}
    assert {tuple(sorted(p)) for p in got} == want and len(want) > 1500


def test_texts_with_one_common_line_do_not_meet_by_chance(spark):
    """Small texts, half of them with the same license line: the share of those in bands with others
    does not grow. It was 54 % of 500 and 75 % of 2000 where bands had empty registers to agree by."""
    from pyspark.sql import functions as F

    from studyloom.llm.near_dedup import band_groups, signatures

    rng = np.random.default_rng(8)
    line = " ".join(f"license{k}" for k in range(12))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 40)) + (f" {line}" if i % 2 else ""))
            for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def share(n):
        shared = band_groups(signatures(docs.filter(f"doc_id < {n}"))).groupBy("key").agg(
            F.collect_set("node").alias("nodes")).filter("size(nodes) > 1")
        return shared.select(F.explode("nodes").alias("node")).distinct().count() / n

    assert share(500) < 0.1 and share(2000) < 0.1


def test_similar_small_texts_share_a_band_whatever_their_rounds():
    """Pairs of similarity 0.75 agree in a band as often as four free registers do: 0.75 ** 4."""
    from studyloom.llm.near_dedup import BANDS, bands, rounds, size_class

    rng = np.random.default_rng(9)
    assert [rounds(size_class(n, 75), 75) for n in (1, 600, 20000)] == [128, 1, 1]
    for n in (4, 12, 20, 44, 100, 200, 380):
        agree, pairs = 0, 600
        for _ in range(pairs):
            every, both = rng.integers(0, 1 << 64, n, dtype=np.uint64), 3 * n // 4
            cut = int(rng.integers(both, n + 1))
            (c, one), (d, two) = sorted((bands(np.sort(every[:cut]), 75), bands(
                np.sort(np.concatenate([every[:both], every[cut:]])), 75)), key=lambda x: x[0])
            assert d - c <= 1  # their class is the later one
            one = one[:BANDS] if c == d else one[-BANDS:]
            agree += ((one == two[:BANDS]) & (one != -1)).sum()
        assert abs(agree / pairs / BANDS - 0.75 ** 4) < 0.03
