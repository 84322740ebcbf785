"""Words of texts as numpy arrays: places, 64-bit hashes, and sets of word shingles.

A word is a maximal run of characters other than space and \\x09-\\x0D, as in
``[^\\x20\\x09-\\x0D]+``. All six separators are single UTF-8 bytes, so words are found on the
bytes of a whole Arrow batch at once; no text is split in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes hashed with one table of powers; a batch is cut there, a longer word is hashed alone.
_STRETCH = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWER = _powers(_BASE, _STRETCH + 1)
_BACK = _powers(_INVERSE, _STRETCH + 1)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the n + 1 places where its texts begin (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if buffers[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Words of a batch of texts: `start` and `end` (bytes), `first` (per text, n + 1)."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.data, self.begin = text_bytes(texts)
        if lower:
            self.data = _LOWER[self.data]
        inside = np.zeros(len(self.data) + 2, dtype=bool)
        inside[1:-1] = ~_SEPARATOR[self.data]
        starts = inside[1:] & ~inside[:-1]
        starts[self.begin[:-1]] |= inside[1:][self.begin[:-1]]
        self.start = np.flatnonzero(starts[:-1])
        # a word ends at a separator or where the next text begins
        stops = ~inside[1:]
        stops[self.begin[1:]] = True
        stop_at = np.flatnonzero(stops)
        self.end = stop_at[np.searchsorted(stop_at, self.start, side="right")]
        self.first = np.searchsorted(self.start, self.begin)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word: a polynomial of byte codes, then mixed."""
        out = np.empty(len(self.start), dtype=np.uint64)
        i, n = 0, len(self.start)
        while i < n:
            base = self.start[i]
            j = int(np.searchsorted(self.end, base + _STRETCH, side="right"))
            if j <= i:  # one word longer than a stretch
                out[i] = self._long(self.start[i], self.end[i])
                i += 1
                continue
            codes = _BYTE_CODE[self.data[base:self.end[j - 1]]]
            codes *= _POWER[:len(codes)]
            sums = np.empty(len(codes) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(codes, out=sums[1:])
            at, to = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = (sums[to] - sums[at]) * _BACK[at]
            i = j
        out += (self.end - self.start).astype(np.uint64)
        return mix(out)

    def _long(self, start: int, end: int) -> np.uint64:
        total, factor, step = 0, 1, pow(_BASE, _STRETCH, 1 << 64)
        for at in range(start, end, _STRETCH):
            codes = _BYTE_CODE[self.data[at:min(end, at + _STRETCH)]]
            part = int((codes * _POWER[:len(codes)]).sum(dtype=np.uint64))
            total = (total + part * factor) & _MASK
            factor = factor * step & _MASK
        return np.uint64(total)


def window_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive words, texts not told apart (the caller masks ends)."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += word_hash[k:k + n] * np.uint64(pow(_BASE, k + 1, 1 << 64))
    return mix(total)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its `size`-word shingles, A-Z lower-cased.

    A text with fewer words has its whole word sequence as the one shingle; a text without
    words, or null, has none.
    """
    words = Words(texts, lower=True)
    hashes = words.hashes()
    windows = window_hashes(hashes, size)
    out = []
    first = words.first
    for t in range(len(first) - 1):
        a, b = first[t], first[t + 1]
        if b - a >= size:
            out.append(np.unique(windows[a:b - size + 1]))
        elif b > a:
            few = window_hashes(hashes[a:b], int(b - a))
            out.append(mix(few + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


_KEPT: dict[tuple, object] = {}


def kept(kind: str, key: object, make):
    """What a Python worker keeps between tasks: one table at a time, as memory is shared."""
    if (kind, key) not in _KEPT:
        _KEPT.clear()
        _KEPT[kind, key] = make()
    return _KEPT[kind, key]


def drop_kept() -> None:
    """Give up what earlier tasks of this worker have kept."""
    _KEPT.clear()


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20):
    """Parts of an Arrow batch with at most about `size` bytes of text, one row at least."""
    begin = text_bytes(batch.column(column))[1]
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
