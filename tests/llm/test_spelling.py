import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from studyloom.llm import queries, spelling
from studyloom.llm.spelling import near_pairs, planted_words, spelling_forms


def words_of(rows, least_length=5, least_times=3):
    lower = {c: c + 32 for c in range(65, 91)}
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least_times}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def all_near(words):
    """Near words by looking every deletion and gap up; checked one by one."""
    shapes = defaultdict(set)
    for w in words:
        shapes[w].add(w)
        for k in range(len(w)):
            shapes[w[:k] + w[k + 1:]].add(w)
    near = defaultdict(set)
    for group in shapes.values():
        for a in group:
            near[a] |= {b for b in group if is_near(a, b)}
    return near


def brute(words):
    near, form, out = all_near(words), {}, []
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.select(
        "word", "form", "root", "n", "n_near", "form_n").collect())


def made_up(n, seed, signs="abcdeé", lengths=(5, 9)):
    rng = random.Random(seed)
    out = {}
    while len(out) < n:
        word = "".join(rng.choice(signs) for _ in range(rng.randrange(*lengths)))
        out[word] = rng.choice([3, 3, 4, 6, 7, 12, 25, 100, 1000])
    return out


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)


def test_equals_all_pairs_in_many_cells(spark, monkeypatch):
    words = made_up(3000, 1)
    monkeypatch.setattr(spelling, "CELL", 64)
    monkeypatch.setattr(spelling, "SAMPLE", 700)
    assert found(spelling_forms(frame(spark, words))) == brute(words)


def test_few_letters_and_equal_counts(spark, monkeypatch):
    words = made_up(1500, 2, signs="ab", lengths=(5, 14))
    monkeypatch.setattr(spelling, "CELL", 64)
    assert found(spelling_forms(frame(spark, words))) == brute(words)


def test_masked_join_gives_the_same_pairs(monkeypatch):
    words = sorted(made_up(800, 3, signs="abz中", lengths=(6, 8)))
    groups = {k: [w for w in words if len(w) == k] for k in (6, 7)}
    for asked in (6, 7):
        want = {(a, b) for a in groups[asked] for b in groups[7] if is_near(a, b)}
        for dense in (0, 1 << 30):
            monkeypatch.setattr(spelling, "DENSE", dense)
            i, j = near_pairs(groups[asked], groups[7], 7)
            got = [(groups[asked][a], groups[7][b]) for a, b in zip(i, j)]
            assert len(got) == len(set(got)) and set(got) == want


def test_long_words_and_chains(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    words = {long: 3, long[:777] + long[778:]: 9, long[:5] + "z" + long[6:]: 4}
    for k in range(12):  # each form is one letter longer and twice as frequent
        words["chain" + "x" * k] = 3 * 2 ** k
    got = {r.word: r for r in spelling_forms(frame(spark, words)).collect()}
    assert got["chain"].root == "chain" + "x" * 11 and got["chainx"].n_near == 2
    assert got[long].form == long[:777] + long[778:] and got[long].n_near == 2


def test_nulls_repeats_and_empty_tables(spark):
    schema = "word string, n long, form string, root string, near long, cell int"
    rows = [(None, 5), ("", 4), ("about", 10), ("about", 12), ("abouts", 3), ("none", None)]
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], schema)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_forms(df).collect()}
    assert got == {None: (None, None, 5, 0, None), "": (None, "", 4, 0, None),
                   "none": (None, "none", None, 0, None),
                   "about": (None, "about", 12, 1, None),
                   "abouts": ("about", "about", 3, 1, 12)}
    assert spelling_forms(df.limit(0)).count() == 0
    none = spark.createDataFrame([], "doc_id long, text string")
    assert planted_words(none).count() == 0


def test_words_of_odd_texts(spark):
    rows = [(k, t) for k, t in enumerate(
        ["Weiß×÷ÿ ÀÉÎ naïve Naïve NAÏVE", None, "", "ſtraße İstanbul K"] + ["abcdef " * 30] * 200)]
    rows += [(None, "some others, some others"), (None, None), (3, "x" * 1_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in planted_words(df, 2, 1).collect()}
    assert got == words_of(rows, 2, 1)


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in
            queries.table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_count_tree_spelling"](spark, folder)
    assert found(got) == brute(words_of(rows))


def test_boxes_lose_no_pair():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 3, (400, spelling.DIMENSIONS)).astype(np.int8)
    top, leaves = spelling.build_top(points, 20)
    home = {}
    zero = np.zeros(400, np.int32)
    for leaf, at in spelling.reach(top, np.arange(400), points, zero, zero):
        home.update(dict.fromkeys(at.tolist(), leaf))
    assert sorted(home) == list(range(400)) and leaves > 10
    moved = points.copy()
    for k, row in enumerate(moved):
        a, b = rng.permutation(spelling.DIMENSIONS)[:2]
        row[a] += 1
        row[b] -= 1
    reached = {(k, leaf) for leaf, at in spelling.reach(
        top, np.arange(400), moved, zero + 1, zero + 1) for k in at.tolist()}
    assert all((k, leaf) in reached for k, leaf in home.items())
