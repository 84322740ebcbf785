import hashlib
import random

import numpy as np
import pytest

from studyloom.llm import queries
from studyloom.llm.piece_codec import PieceCodec, encode_and_decode

PATH = queries.vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def tool():
    return PieceCodec(PATH)


def same(tool, library, text):
    ids, want = np.frombuffer(tool.encode(text), "<i4"), library.encode(text)
    assert ids.tolist() == want, repr(text)
    assert tool.decode_all(ids, np.array([len(ids)])) == [library.decode(want)], repr(text)


def test_equals_the_library_on_made_up_texts(tool, library):
    rng = random.Random(5)
    signs = list("abcdefghi  \n\t▁▁.,;'\"0123éàü中文\x00​﻿<>s/unk") + ["𝄞"]
    pieces = list(tool.id_of)
    for k in range(4000):
        if k % 2:
            text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 60)))
        else:
            text = "".join(rng.choice(pieces).replace("▁", rng.choice([" ", "▁", ""]))
                           for _ in range(rng.randrange(1, 12)))
        same(tool, library, text)


def test_equals_the_library_on_odd_texts(tool, library):
    for text in ["", " ", "   ", "\n", "\n\n a", " a  b ", "▁", "<s>", "</s> <unk>", "<0x41>", "a\x00b",
                 "a" * 999, "ab" * 60_000, "word " * 40_000, "\n" * 1000, "x́" * 50]:
        same(tool, library, text)


def test_decodes_any_ids_as_the_library(tool, library):
    rng = random.Random(6)
    space = tool.id_of["▁"]
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), space])
               for _ in range(rng.randrange(8))]
        assert tool.decode_all(np.array(ids, "<i4"), np.array([len(ids)])) == [library.decode(ids)]


def test_full_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr("studyloom.llm.piece_codec.KEPT_UNITS", 3)
    monkeypatch.setattr("studyloom.llm.piece_codec.KEPT_PAIRS", 3)
    small = PieceCodec(PATH)
    for text in ["some words and some words more often", "unwieldy counterrevolutionaries"]:
        same(small, library, text)


def test_one_row_per_document(spark, docs, rows, no_docs, library):
    got = encode_and_decode(docs, PATH).collect()
    want = [(r[0], library.encode(r[1] or ""), library.decode(library.encode(r[1] or "")))
            for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert encode_and_decode(no_docs, PATH).count() == 0


def test_query_digests(spark, tmp_path, docs, rows, library):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_backtracking_piece_codec"](spark, str(tmp_path)).collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for r in rows:
        ids = library.encode(r[1] or "")
        want.append((r[0], len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
