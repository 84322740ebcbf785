"""Tokens, files, packing, language, scores and top-k against libraries and brute force."""

import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from studyloom.llm.backoff import score_documents
from studyloom.llm.encoding import WordEncoder, encode_documents
from studyloom.llm.language_id import identify, keep_identified
from studyloom.llm.packing import assign, pack, pack_texts
from studyloom.llm.token_counts import PieceCounter, token_counts
from studyloom.llm.token_files import EliasFano, document_digests, write_store
from studyloom.llm.topk import top_k

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = "ab the ing\n\t éÅ中😀▁\x00<|endoftext|>12 　\xa0"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ids_of(rows):
    tool = Tokenizer.from_file(BYTES)
    return [(i, tool.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, _, _ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=40).map("".join))
def test_piece_counts_match_the_library(text):
    global _COUNTER, _MODEL
    if "_COUNTER" not in globals():
        _COUNTER = PieceCounter(PIECES)
        _MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert _COUNTER.count(text) == len(_MODEL.encode(text))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*SIGNS, "the", "x.", "\n"]), max_size=30).map("".join),
                max_size=4))
def test_word_encoder_matches_the_library(texts):
    global _ENCODER
    if "_ENCODER" not in globals():
        _ENCODER = WordEncoder(BYTES)
    for text, ids in zip(texts, _ENCODER.encode(texts)):
        expected = _ENCODER.tool.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected


def test_token_counts(docs, rows, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = collections.Counter()
    for i, t, _, _ in rows:
        n = len(model.encode(t or ""))
        expected[(i, len((t or "").encode()), n, n > 4096)] += 1
    assert collections.Counter(map(tuple, token_counts(docs, PIECES).collect())) == expected
    assert token_counts(no_docs, PIECES).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano_round_trip(steps):
    values = np.cumsum(np.array(steps, dtype=np.int64))
    code = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    assert code.all().tolist() == values.tolist()
    assert [code.select(i) for i in range(0, len(values), 37)] == values[::37].tolist()
    if len(values) > 300 and values[-1]:
        bits = 8 * (len(code.low) + len(code.high))
        assert bits <= len(values) * (3 + max(0, math.log2(values[-1] / len(values)))) + 16


def test_token_store(docs, rows, no_docs, spark, tmp_path):
    path = write_store(docs, BYTES, str(tmp_path / "store"), shard_ids=500)
    got = sorted(document_digests(spark, path).collect(), key=lambda r: r.start)
    ids = sorted(((i is not None, i or 0, t or "", x) for (i, x), (_, t, _, _)
                  in zip(ids_of(rows), rows)), key=lambda r: r[:2])
    assert [r.doc_id for r in got] == [i if known else None for known, i, _, _ in ids]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == \
        collections.Counter((i, len(x), crc(x)) for i, x in ids_of(rows))
    empty = write_store(no_docs, BYTES, str(tmp_path / "none"))
    assert document_digests(spark, empty).count() == 0


def check_packing(pieces, documents, size):
    spans = collections.defaultdict(list)
    for p in pieces:
        spans[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sum(n for p in spans.values() for _, n in p) == sum(map(len, documents))
    return spans


def test_packing(docs, rows, no_docs):
    pieces = pack(encode_documents(docs, BYTES), block_tokens=3000).collect()
    assert sorted(map(tuple, pieces), key=str) == sorted(
        map(tuple, pack_texts(docs, BYTES, block_tokens=3000).collect()), key=str)
    documents = ids_of(rows)
    check_packing(pieces, [x for _, x in documents], 1024)
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for i, x in documents:
        if i not in (None, 15):
            parts = sorted(by_doc[i], key=lambda p: p.start)
            at = 0
            for p in parts:
                assert p.start == at and p.doc_tokens == len(x)
                assert p.ids_crc32 == crc(x[at:at + p.length])
                assert p.ids == np.array(x[at:at + p.length], "<u4").tobytes()
                at += p.length
            assert at == len(x)
    assert pack(encode_documents(no_docs, BYTES)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=40))
def test_a_block_leaves_less_than_one_sequence_free(lengths):
    pieces = assign(np.array(lengths, dtype=np.int64), size=16)
    rows = [dict(sequence_id=s, offset=o, length=n) for _, _, n, s, o in pieces]
    spans = check_packing(rows, [[0] * n for n in lengths], 16)
    assert len(spans) * 16 - sum(lengths) < 16


def test_packing_balances_cost():
    lengths = np.random.default_rng(3).integers(20, 500, 400)
    cost = collections.Counter()
    for _, _, n, s, _ in assign(lengths):
        cost[s] += n + n * n / 512
    values = sorted(cost.values())
    assert values[-1] < 1.6 * values[len(values) // 2]


def test_language(spark):
    import random

    parts = {"en": "the of and ing tion er", "de": "der und sch ei ung zu", "es": "el los ción de o a"}
    rng, rows = random.Random(4), []
    for k in range(240):
        lang = sorted(parts)[k % 3]
        words = ["".join(rng.choices(parts[lang].split(), k=rng.randrange(1, 4))) for _ in range(30)]
        rows.append((k, " ".join(words).capitalize(), lang))
    rows += [(1000, None, "en"), (1001, "12 .. ²", "en"), (None, "der und die schule", None),
             (1002, "the " * 40_000, None), (1003, "x" * 5000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(
        "score", F.lit("x")).withColumn("held_out", F.lit("x"))
    got = {r.doc_id: r for r in identify(docs, PIECES).collect()}
    assert len(got) == len(rows)
    for i, text, lang in rows:
        assert got[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= got[i].score <= 1
    held = [(got[i].lang_pred, lang) for i, _, lang in rows[:240] if got[i].held_out]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1000].score == 0
    assert got[1002].lang_pred == "en" and got[None].lang_pred == "de"
    kept = keep_identified(docs, PIECES)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(240))
    assert not {1000, 1001} & {r.doc_id for r in kept.collect()}


def test_language_without_labels(spark, no_docs):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string").withColumn(
        "lang", F.lit(None).cast("string"))
    assert [tuple(r)[2:] for r in identify(docs, PIECES).collect()] == [("und", 0.0)]
    assert identify(no_docs, PIECES).count() == 0


def letter_pieces():
    """Lower-cased pieces of letters, read from the file alone."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return sorted(p for p in pieces if p and all(c.isalpha() for c in p.removeprefix("▁")))


def test_forward_pass_sums_all_segmentations():
    """Against sums that know only the vocabulary file and the probabilities, in exact fractions."""
    from fractions import Fraction
    from studyloom.llm import language_id as lid

    vocabulary, pieces = lid.piece_vocabulary(PIECES), letter_pieces()
    assert vocabulary.size == len(pieces) and vocabulary.longest == max(map(len, pieces)) == 16
    number = {}
    for piece in pieces:
        h = np.zeros(1, np.uint64)
        for sign in piece:
            h = lid._extend(h, np.array([ord(sign)], np.uint64))
        number[piece] = int(np.searchsorted(vocabulary.hashes, lid.mix(h)[0]))
    assert sorted(number.values()) == list(range(len(pieces)))
    p = np.random.default_rng(1).random((len(pieces) + 1, 2)) / 100
    longest = next(x for x in pieces if len(x) == 16)
    words = ["the", "ab中", "a", "tion", longest.removeprefix("▁"), "中" * 40,
             "donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterb", "q" * 500]
    models = lid.Model(["x", "y"], vocabulary, p.T)
    got = models.word_scores(words)
    for model in range(2):
        for k, word in enumerate(words):
            marked = "▁" + word
            sums = [Fraction(1)]
            for end in range(1, len(marked) + 1):
                total = Fraction(0)
                for start in range(max(0, end - 16), end):
                    piece = marked[start:end]
                    if piece in number or len(piece) == 1:
                        total += sums[start] * Fraction(float(p[number.get(piece, -1), model]))
                sums.append(total)
            want = math.log(sums[-1].numerator) - math.log(sums[-1].denominator)
            assert got[k, model] == pytest.approx(want, rel=1e-9), word
    for word in (*words, "x" * 5000, "donaudampfschifffahrt" * 300):  # in stretches and at once
        whole = next(lid.lattices([word], vocabulary))[1].forward(p)[2][0]
        for stretch in (16, 50, 4096):
            lid.LONG, before = stretch, lid.LONG
            assert models.long_score(word, p) == pytest.approx(whole, rel=1e-9)
            lid.LONG = before
    counts = np.array([3.0, 1, 2, 1, 2, 1, 4, 1])
    for order in (words, words[::-1]):
        chunks = list(lid.lattices(order, vocabulary))
        times = counts if order is words else counts[::-1]
        uses = sum(lattice.expected(p[:, 0], times[chunk]) for chunk, lattice in chunks)

        def likelihood(q):
            return sum((times[c] * lat.forward(q.reshape(-1, 1))[2][:, 0]).sum() for c, lat in chunks)

        # expected uses are p times the slope of the log likelihood
        for piece in np.argsort(-uses)[:8]:
            up, down = p[:, 0].copy(), p[:, 0].copy()
            up[piece] *= 1 + 1e-5
            down[piece] *= 1 - 1e-5
            slope = (likelihood(up) - likelihood(down)) / 2e-5
            assert uses[piece] == pytest.approx(slope, rel=1e-4)


def brute_scores(rows, order, alpha, leave_out):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for _, t, _, _ in rows]
    grams = [collections.Counter(tuple(w[k - n:k]) for n in range(1, order + 1)
                                 for k in range(n, len(w) + 1)) for w in texts]
    total = sum(grams, collections.Counter())
    words = sum(map(len, texts))
    out = []
    for (i, _, _, _), w, own in zip(rows, texts, grams):
        def c(g):
            return total[g] - (own[g] if leave_out else 0)
        rest, score, backed = max(words - (len(w) if leave_out else 0), 1), 0.0, 0
        for k in range(len(w)):
            s = (c((w[k],)) or 0.5) / rest
            for n in range(2, min(order, k + 1) + 1):
                g = tuple(w[k - n + 1:k + 1])
                s = c(g) / c(g[:-1]) if c(g) else alpha * s
                backed += n == order and not c(g)
            score += math.log(s)
        out.append((i, len(w), backed, round(score, 6)))
    return out


@pytest.mark.parametrize("order, leave_out, limit", [(3, True, 10**6), (2, False, 50), (4, True, 20)])
def test_stupid_backoff(docs, rows, order, leave_out, limit):
    got = score_documents(docs, order=order, leave_out=leave_out, block_words=300,
                          bucket_ngrams=limit).collect()
    found = sorted([(r.doc_id, r.n_words, r.n_backed_off, round(r.log_score, 6)) for r in got],
                   key=str)
    expected = sorted(brute_scores(rows, order, 0.4, leave_out), key=str)
    for a, b in zip(found, expected, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-5)


def test_stupid_backoff_empty(no_docs):
    assert score_documents(no_docs).count() == 0


@pytest.mark.parametrize("spread", [1.0, 1e6])
def test_top_k(spark, spread):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=19) * spread]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(400, None), (420, [1.0, float("nan")] + [0.0] * 17), (440, [None] * 19),
             (460, [float("inf")] * 19), (None, rows[0][1]), (480, []), (500, [2.0, 3.0]),
             (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit("x")).withColumn("block", F.lit("x")).repartition(4)
    got = collections.defaultdict(list)
    for r in top_k(df, F.col("vec_id") % 20 == 0, k=20, scale=64).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q in {i for i, _ in good if i % 20 == 0}:
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q
                  for v in [next(v for j, v in good if j == q)]]
        best = sorted(scores)[:20]
        if q == 20:  # the query stands in two rows
            assert [i for _, i, _ in sorted(got[q])][:1] == [best[0][1]]
            continue
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert set(got) == {i for i, _ in good if i % 20 == 0}


def test_top_k_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") % 20 == 0).count() == 0
    assert top_k(df.filter("vec_id > 5"), F.col("vec_id") % 20 == 0).count() == 0


def test_many_buckets_deal_ngrams_alike():
    from studyloom.llm.backoff import _Grams

    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 50, 2000).astype(np.uint64)
    places = np.arange(2000) % 100
    few, many = (_Grams(hashes, places, 2, n) for n in (7, 1 << 17))
    assert (few.at == many.at).all() and len(few.low) == len(many.low)
    pairs = set(zip(few.which.tolist(), many.which.tolist()))
    assert len(pairs) == len(few.low)
    assert sum(1 for _ in many.lists()) == len(set(many.bucket.tolist()))
