"""Token ids of whole texts by a public byte-level BPE file.

The library encodes each distinct word once per worker. Cuts are made only where its own word
pattern always begins a new unit (a space or line break between two characters that are not
white space), so the ids of a text are the ids of its parts in order. Texts with other white
space are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.words import kept, slices

#: Words kept per worker; others are encoded again when they come up in a later batch.
KEPT_WORDS = 400_000
#: Bytes of text encoded together: words that repeat there are encoded once.
TOGETHER = 3 << 20
END_ID = 0
_ODD_SPACE = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029"
                        "\\u202f\\u205f\\u3000]")


class WordEncoder:
    """Ids as bytes (little-endian, 4 bytes each) for one vocabulary file.

    A word is kept with the line break before it, if there is one; the first word of a text is
    looked up as if it began a line, and the break's id is left off.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        size = self.tool.get_vocab_size()
        lengths = [len(self.tool.id_to_token(i) or "") for i in range(size)]
        self.lengths = np.array(lengths, dtype=np.int64)  # one sign per byte
        self.added = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        self.line = len(self._whole("\n"))
        self.words: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        ids = self.tool.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4")

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def cuttable(self, text: str) -> bool:
        """True if every space and line break of the text begins a new unit."""
        if "  " in text or text[0] in " \n" or text[-1] in " \n":
            return False
        if "\n" in text and ("\n\n" in text or " \n" in text or "\n " in text):
            return False
        if not text.replace("\n", "").isprintable() and _ODD_SPACE.search(text):
            return False
        return not any(t in text for t in self.added)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        waiting, unknown = [], []
        get, line = self.words.get, self.line
        for k, text in enumerate(texts):
            if not text:
                continue
            if not self.cuttable(text):
                out[k] = self._whole(text)
                continue
            words = ("\n" + text.replace("\n", " \n")).split(" ")
            ids = list(map(get, words))
            if None in ids:
                gaps = [i for i, x in enumerate(ids) if x is None]
                missing = [words[i] for i in gaps]
                unknown += missing
                waiting.append((k, ids, gaps, missing))
            else:
                out[k] = b"".join(ids)[line:]
        if waiting:
            found = self._learn(unknown)
            for k, ids, gaps, missing in waiting:
                for i, word in zip(gaps, missing):
                    ids[i] = found[word]
                out[k] = b"".join(ids)[line:]
        return out

    def _learn(self, unknown: list[str]) -> dict[str, bytes]:
        """Ids of words, many per call of the library.

        Words that came up more than once are kept; the others only while a quarter of the table is empty.
        """
        found: dict[str, bytes] = {}
        times = Counter(unknown)
        words = list(times)
        for at in range(0, len(words), 20_000):
            chunk = words[at:at + 20_000]
            marked = [w if w[0] == "\n" else " " + w for w in chunk]
            ids = self._ids("".join(marked))
            ends = np.cumsum(self.lengths[ids])
            reach = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in marked])
            cut = np.concatenate([[0], np.searchsorted(ends, reach, side="left") + 1])
            if ends[-1] != reach[-1] or (ends[cut[1:] - 1] != reach).any():
                raise ValueError("a token goes over the end of a word")
            raw, places = ids.tobytes(), (4 * cut).tolist()
            found.update(zip(chunk, [raw[a:b] for a, b in zip(places, places[1:])]))
        table = self.words
        if len(table) < KEPT_WORDS:
            often = KEPT_WORDS * 3 // 4 <= len(table)
            table.update((w, found[w]) for w, n in times.items()
                         if (n > 1 or not often) and len(w) < 64)
        return found


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    return kept("encoder", path, lambda: WordEncoder(path))


def encode_batches(batches: Iterator[pa.RecordBatch],
                   vocabulary: str) -> Iterator[tuple[list, list[bytes]]]:
    """(doc_ids, ids of each document with the end id) for slices of Arrow batches."""
    tool, end = encoder(vocabulary), np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        for part in slices(batch, size=TOGETHER):
            encoded = tool.encode(part.column("text").to_pylist())
            yield part.column("doc_id").to_pylist(), [x + end for x in encoded]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of `docs`: doc_id, ids (binary, 4 bytes per id, with the end id).

    Null text is empty and has the end id alone; a null doc_id stays null.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids in encode_batches(batches, vocabulary):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, ids binary")
