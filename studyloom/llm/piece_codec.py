"""Exact piece encoding by backtracking, and decoding, for a public merge-type piece model.

The merge procedure of such a model has one result, and a sequence of pieces is that result exactly
if every piece is its own result and every two adjacent pieces are theirs. So a stretch of text is
encoded from the left: an Aho-Corasick automaton over the pieces gives the longest piece at each
place; a piece stays if merging it anew together with the piece before it gives these two again; else
the next shorter piece is tried, and if none is left the place is marked as failed in a bit field and the
piece before it is taken back. The pieces up to a place are the same whichever way it was reached, so
a failed place fails for good and the work is linear but for the lengths of pieces.

No piece of such a vocabulary goes on after its last letter with a space mark, so a normalised text
falls into units (marks and the letters after them) that no piece crosses. A worker keeps the ids of
units in a bounded table; a unit that is not there is encoded again.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from struct import Struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.words import kept, slices

MARK = "▁"
#: Units and pairs of pieces kept per worker; others are worked out again when they come up.
KEPT_UNITS, KEPT_PAIRS = 700_000, 300_000
#: Bytes of text that are encoded together.
TOGETHER = 4 << 20
_UNKNOWN_TEXT = " ⁇ "


class PieceCodec:
    """Ids of texts and texts of ids for one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        # only vocabulary and normalisation are taken from the library
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)
                   or model.is_byte(i)}
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("a vocabulary with unused pieces is split in another way")
        self.text_of = [model.id_to_piece(i) for i in range(size)]
        self.id_of = {self.text_of[i]: i for i in range(size) if i not in special}
        self.byte_id = {int(self.text_of[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        score = {model.get_score(i) for i in self.id_of.values()}
        place = {s: k for k, s in enumerate(sorted(score, reverse=True))}
        self.rank = {p: place[model.get_score(i)] for p, i in self.id_of.items()}
        own = [p for p in self.id_of if len(p) == 1 or self.merged(list(p)) == [p]]
        self.whole = {p: self.id_of[p] for p in own}
        self.size = np.array([len(p) for p in self.text_of], dtype=np.int64).tolist()
        self.shorter = [-1] * size
        for p, i in self.whole.items():
            self.shorter[i] = next(
                (self.whole[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.whole), -1)
        self._build_automaton()
        long = [p for p in self.id_of if len(p) > 1]
        inner = any(a != MARK and b == MARK for p in long for a, b in zip(p, p[1:]))
        breaks = "" if inner else (MARK if any("\n" in p for p in long) else MARK + "\n")
        self.unit = re.compile(
            "(?s).+" if not breaks else f"\n|{MARK}*[^{breaks}]+|{MARK}+" if "\n" in breaks
            else f"{MARK}*[^{breaks}]+|{MARK}+")
        self.packed = [Struct(f"<{n}i") for n in range(64)]
        self.units: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self._build_decoder(special)

    def _build_automaton(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for p, i in self.whole.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge the adjacent pair of lowest rank, leftmost first, until no pair is a piece."""
        get = self.rank.get
        while len(symbols) > 1:
            ranks = [get(a + b, 1 << 60) for a, b in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def fits(self, a: int, b: int) -> bool:
        """True if merging two pieces anew gives the same two."""
        known = self.pairs.get(a << 32 | b)
        if known is None:
            known = self._remerged(self.text_of[a], self.text_of[b])
            if len(self.pairs) < KEPT_PAIRS:
                self.pairs[a << 32 | b] = known
        return known

    def _remerged(self, left: str, right: str) -> bool:
        get, none = self.rank.get, 1 << 60
        symbols, border = list(left + right), len(left) - 1
        ranks = [get(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while ranks[border] != none or len(ranks) > 1:
            best = min(ranks)
            at = ranks.index(best)
            if at == border or best == none:
                return best == none
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get(symbols[at - 1] + symbols[at], none)
            if at < len(ranks):
                ranks[at] = get(symbols[at] + symbols[at + 1], none)
            border -= at < border
        return True

    def encode_unit(self, text: str) -> list[int]:
        """Pieces of a stretch of normalised text; a letter that is no piece is -1 - its code."""
        n, sizes, shorter, pairs = len(text), self.size, self.shorter, self.pairs
        out: list[int] = []
        at, last = 0, -1
        for end, piece in self.automaton.iter_long(text):  # the longest pieces from the left
            known = last < 0 or pairs.get(last << 32 | piece)
            if known is None:
                known = self.fits(last, piece)
            if not known or end - at + 1 != sizes[piece]:
                break
            out.append(piece)
            at, last = end + 1, piece
        if at == n:
            return out
        longest = [-1] * n
        for end, piece in self.automaton.iter(text):  # a later end is a longer piece
            longest[end - sizes[piece] + 1] = piece
        failed = bytearray(n // 8 + 1)
        piece = longest[at]
        while at < n:
            if piece < 0:  # an unknown letter merges with nothing
                out.append(-1 - ord(text[at]))
                at += 1
                piece = longest[at] if at < n else -1
                continue
            last = out[-1] if out else -1
            while piece >= 0:
                end = at + sizes[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    known = last < 0 or pairs.get(last << 32 | piece)
                    if known or known is None and self.fits(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at = end
                piece = longest[at] if at < n else -1
            elif last < 0:
                raise ValueError("the vocabulary is not of the merge type")
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= sizes[piece]
        return out

    def unit_ids(self, unit: str) -> bytes:
        ids = self.encode_unit(unit)
        if min(ids) < 0:
            ids = self._with_bytes(ids)
        raw = self.packed[len(ids)].pack(*ids) if len(ids) < 64 else array("i", ids).tobytes()
        if len(self.units) < KEPT_UNITS and len(unit) < 64:
            self.units[unit] = raw
        return raw

    def _with_bytes(self, pieces: list[int]) -> list[int]:
        ids: list[int] = []
        for piece in pieces:
            if piece >= 0:
                ids.append(piece)
            elif self.byte_id:
                ids += [self.byte_id[b] for b in chr(-1 - piece).encode()]
            elif not ids or ids[-1] != self.unknown:  # unknown letters side by side are one
                ids.append(self.unknown)
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, 4 bytes each, little-endian."""
        if not text:
            return b""
        units = self.unit.findall(self.model.normalize(text))
        found = list(map(self.units.get, units))
        if None in found:
            found = [self.unit_ids(u) if x is None else x for u, x in zip(units, found)]
        return b"".join(found)

    def _build_decoder(self, special: set[int]) -> None:
        """Bytes of every id in one array, with the places where they begin."""
        parts = []
        for i, piece in enumerate(self.text_of):
            if i == self.unknown:
                parts.append(_UNKNOWN_TEXT.encode())
            elif self.model.is_control(i):
                parts.append(b"")
            elif i in special:
                parts.append(bytes([int(piece[1:-1], 16)]))
            else:
                parts.append(piece.replace(MARK, " ").encode())
        self.parts = parts
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        self.width = np.array([len(p) for p in parts], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        self.marked = np.array([p.startswith(MARK) for p in self.text_of])
        self.prefix = self.model.normalize("a").startswith(MARK)
        self.control = np.array([self.model.is_control(i) for i in range(len(parts))])
        self.is_byte = np.array([self.model.is_byte(i) for i in range(len(parts))])

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of many id sequences that follow each other; `ends`: where each one ends."""
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        width = self.width[ids]
        if self.prefix:  # the mark put before a text goes again
            heads = begins[begins < ends]
            heads = heads[self.marked[ids[heads]]]
        else:
            heads = np.empty(0, np.int64)
        to = np.cumsum(width)
        total = int(to[-1]) if len(to) else 0
        source = np.repeat(self.begin[ids] - (to - width), width) + np.arange(total)
        data = self.flat[source].tobytes()
        reach = np.concatenate([[0], to])
        start, stop = reach[begins], reach[ends]
        skip = np.zeros(len(ends), np.int64)
        skip[np.searchsorted(begins, heads, side="right") - 1] = 1
        out = []
        plain = not self.control[ids].any()
        for a, b, k in zip((start + skip).tolist(), stop.tolist(), range(len(ends))):
            try:
                text = data[a:b].decode() if plain else None
            except UnicodeDecodeError:
                text = None
            out.append(self._decode_slow(ids[begins[k]:ends[k]]) if text is None else text)
        return out

    def _decode_slow(self, ids: np.ndarray) -> str:
        """One sequence, with byte ids that are no UTF-8 or with control ids."""
        out, run, seen = [], b"", False

        def broken(raw: bytes) -> str:
            text = ""
            while raw:
                for k in (4, 3, 2, 1):
                    try:
                        sign = raw[:k].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(sign) == 1 and len(raw) >= k:
                        break
                else:
                    sign, k = "�", 1
                text, raw = text + sign, raw[k:]
            return text

        for i in ids.tolist():
            if self.is_byte[i]:
                run += self.parts[i]
                seen = True
                continue
            out.append(broken(run))
            run = b""
            text = self.parts[i].decode()
            if self.prefix and not seen and self.marked[i]:
                text = text[1:]
            seen = seen or not self.control[i]
            out.append(text)
        return "".join(out) + broken(run)


def codec(path: str) -> PieceCodec:
    """One codec per worker and file."""
    return kept("codec", path, lambda: PieceCodec(path))


def encode_and_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of `docs`: doc_id, ids (array of int), decoded (the text that the ids stand for).

    `vocabulary` is the path of a piece model, the same on every executor. Needs doc_id and text;
    other columns are ignored. A null or empty text has no ids and decodes to an empty text; a null
    doc_id stays null; equal rows give equal rows; an empty table gives no rows. Texts and words of
    any length are encoded whole; there is no shuffle, and a worker holds a few MB of text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            for part in slices(batch, size=TOGETHER):
                raw = [tool.encode(t) for t in part.column("text").to_pylist()]
                ends = np.cumsum([len(x) // 4 for x in raw])
                ids = np.frombuffer(b"".join(raw), "<i4")
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(tool.decode_all(ids, ends))],
                    names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")
