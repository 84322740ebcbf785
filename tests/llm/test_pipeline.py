"""The pipeline's stages, each against the plain rule on its own input."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from studyloom.llm.language_id import fit, held_out, predict
from studyloom.llm.queries import vocabulary
from tests.llm.conftest import prose

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    """The sample with more rows: repeated ones, a text of megabytes, one word of megabytes."""
    more = rows + [(15, "same row", "en", "a"), (20, prose(20, 30_000), "en", "big"),
                   (21, "w" * 300_000, None, "big"), (22, "\n\n" + prose(21, 9), "en", None)]
    path = tmp_path_factory.mktemp("pipeline")
    df = spark.createDataFrame(more, SCHEMA).repartition(4)
    for name in ("kept", "size", "digest", "_mix_copy", "_exact_digest"):
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(str(path / "documents.parquet"))
    return str(path)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def check_language(spark, before, after):
    model = fit(before.filter(~held_out(F.col("doc_id"))), vocabulary("piece_bpe_32k.model"))
    told = predict(before, model, *[F.col(c) for c in before.columns])
    want = told.filter("_lid_pred <> 'und' and _lid_score >= 0.5").drop("_lid_pred", "_lid_score")
    assert plain(after.collect()) == plain(want.collect())
    assert not [r for r in after.collect() if not re.search(r"[^\W\d_]", r.text or "")]


def check_exact(before, after):
    largest = {}
    for r in before:
        key = (r.text or "").translate(LOWER)
        largest[key] = max(largest.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    want = {(None if i < 0 else i, t) for t, i in largest.items()}
    got = [(r.doc_id, (r.text or "").translate(LOWER)) for r in after]
    assert len(got) == len(set(got)) and set(got) == want


def check_near(before, after):
    rows = [(r.doc_id, shingles(r.text)) for r in before if r.doc_id is not None]
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for k, (i, a) in enumerate(rows):
        for j, b in rows[k + 1:]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    want = [r for r in before if r.doc_id is None or find(r.doc_id) == r.doc_id]
    assert plain(after) == plain(want)


def check_mixture(before, after):
    size = collections.Counter()
    for r in before:
        size[r.source] += len(words(r.text))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: [3, 1, 2][k % 3] for k, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(size.values()), {}, set(order)
    while open_:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in open_)
                 for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        target.update({s: 2 * size[s] for s in full} if full else share)
        open_ = open_ - full if full else set()
    taken, times = collections.Counter(), collections.Counter(map(repr, map(tuple, after)))
    there = collections.Counter(map(repr, map(tuple, before)))
    for r in after:
        taken[r.source] += len(words(r.text))
    assert all(times[k] <= 2 * there[k] for k in times)
    for s in order:  # whole documents, in shards: off by half a document that is left at most
        largest = max((len(words(r.text)) for r in before if r.source == s), default=0)
        assert abs(taken[s] - target[s]) <= max(largest / 2, 1), s


def check_packing(before, pieces):
    ids, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        ids[p.doc_id].append((p.doc_tokens, p.start, p.length, p.ids, p.ids_crc32))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    times = collections.Counter(r.doc_id for r in before)
    for doc, parts in ids.items():
        covered = collections.Counter()
        for total, start, n, raw, crc in parts:
            assert len(raw) == 4 * n and zlib.crc32(raw) == crc
            covered.update((total, k) for k in range(start, start + n))
        assert sum(covered.values()) == sum(t for t, s, *_ in parts if s == 0)
        assert len([1 for p in parts if p[1] == 0]) == times[doc]
        assert all(np.frombuffer(raw, "<u4")[-1] == 0 for t, s, n, raw, _ in parts if s + n == t)


def test_every_stage_equals_its_rule(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.durable(stage(spark, docs, folder))
        if name == "language id":
            check_language(spark, docs, after)
        else:
            {"exact dedup": check_exact, "near dedup": check_near, "mixing": check_mixture,
             "packing": check_packing}[name](docs.collect(), after.collect())
        if name != "packing":
            assert after.columns == docs.columns
        docs = after


def test_run_gives_the_last_stage(spark, folder):
    pieces = corpus_pipeline.run(spark, folder)
    assert "sequence_id" in pieces.columns and pieces.count() > 0


def test_an_empty_table_runs_through(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
