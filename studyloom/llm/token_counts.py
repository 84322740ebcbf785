"""Token counts by heap-and-linked-list byte-pair merging, without token ids.

The vocabulary file of a public piece model gives pieces and their scores. A word starts as a
linked list of characters; the adjacent pair whose joined piece ranks lowest (highest score, ties to
the left) is popped from a heap and merged until no pair is a piece. The count is the number of
initial symbols minus the number of merges; a character that is no piece counts as its bytes.

No piece of such a vocabulary goes on after its last letter with a space mark, so a text falls into
words whose merges cannot touch each other; the count of each distinct word is worked out once
per worker and kept in a bounded table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from studyloom.llm.words import kept, text_bytes

MARK = "▁"
#: Words kept per worker; others are merged again when they come up in a later batch.
KEPT_WORDS = 600_000


def _merges_of(symbols: list[str], rank: dict[str, int]) -> int:
    """Number of merges made in a list of symbols, which is used up.

    A heap entry is `rank << 32 | left`; it is stale unless the pair that now begins at `left`
    has that rank.
    """
    n = len(symbols)
    get, push, pop = rank.get, heapq.heappush, heapq.heappop
    pair = [get(a + b, -1) for a, b in zip(symbols, symbols[1:])]
    heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
    if not heap:
        return 0
    heapq.heapify(heap)
    pair.append(-1)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = pop(heap)
        left = entry & 0xFFFFFFFF
        if pair[left] != entry >> 32:
            continue
        right = after[left]
        joined = symbols[left] + symbols[right]
        symbols[left] = joined
        pair[right] = -1
        merges += 1
        ahead, behind = after[right], before[left]
        after[left] = ahead
        if ahead < n:
            before[ahead] = left
            r = pair[left] = get(joined + symbols[ahead], -1)
            if r >= 0:
                push(heap, r << 32 | left)
        else:
            pair[left] = -1
        if behind >= 0:
            r = pair[behind] = get(symbols[behind] + joined, -1)
            if r >= 0:
                push(heap, r << 32 | behind)
    return merges


class PieceCounter:
    """Counts for one vocabulary file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                         or model.is_unused(i))}
        place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {piece: place[s] for piece, s in score.items()}
        inner = [p for p in self.rank if len(p) > 1]
        #: True if words are independent of each other
        self.cut = not any(a != MARK and b == MARK for p in inner for a, b in zip(p, p[1:]))
        self.cut_lines = self.cut and not any("\n" in p for p in inner)
        probe = " a  b \n\tÅ ﬁ ４　é " + MARK
        plain = model.normalize(probe) == MARK + probe.replace(" ", MARK)
        self.normalize = None if plain else model.normalize
        self.line = self.count_symbols("\n")
        self.inside: dict[str, int] = {}
        self.opening: dict[str, int] = {}

    def count_symbols(self, symbols: str) -> int:
        """Tokens of a stretch of marked text."""
        rank = self.rank
        start = sum(1 if c in rank else len(c.encode()) for c in symbols)
        return start - _merges_of(list(symbols), rank)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.normalize is not None or not self.cut:
            marked = self.normalize(text) if self.normalize else MARK + text.replace(" ", MARK)
            if not self.cut:
                return self.count_symbols(marked)
            text = marked.replace(MARK, " ")[1:]
        if MARK in text:  # a written mark is the same symbol as a space
            text = text.replace(MARK, " ")
        if not self.cut_lines or "\n" not in text:
            return self._line(text, True)
        lines = text.split("\n")
        return self.line * (len(lines) - 1) + self._line(lines[0], True) + sum(
            self._line(line, False) for line in lines[1:])

    def _line(self, text: str, marked: bool) -> int:
        """Words of one line; `marked`: a mark stands before the first one."""
        if not text and not marked:
            return 0
        words = text.split(" ")
        total = 0
        if "" in words:
            return self._spaced(words, marked)
        if not marked:
            first = words[0]
            n = self.opening.get(first)
            if n is None:
                n = self._learn(self.opening, first, first)
            total, words = n, words[1:]
        counts = list(map(self.inside.get, words))
        if None in counts:
            counts = [self._learn(self.inside, w, MARK + w) if n is None else n
                      for w, n in zip(words, counts)]
        return total + sum(counts)

    def _spaced(self, words: list[str], marked: bool) -> int:
        """As `_line` where spaces stand together: a run of marks goes with the word after it."""
        total, marks = 0, 1 if marked else 0
        for k, word in enumerate(words):
            if k:
                marks += 1
            if word:
                table = (self.opening, self.inside)[marks] if marks < 2 else None
                n = table.get(word) if table is not None else None
                if n is None:
                    n = self._learn(table, word, MARK * marks + word)
                total, marks = total + n, 0
        return total + (self.count_symbols(MARK * marks) if marks else 0)

    def _learn(self, table: dict[str, int] | None, word: str, symbols: str) -> int:
        n = self.count_symbols(symbols)
        if table is not None and len(table) < KEPT_WORDS and len(word) < 64:
            table[word] = n
        return n


def counter(path: str) -> PieceCounter:
    """One counter per worker and file."""
    return kept("counter", path, lambda: PieceCounter(path))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 4096) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `vocabulary` is the path of a piece model, the same on every executor. Needs doc_id and text;
    other columns are ignored. A null or empty text has no bytes and no tokens; a null doc_id stays
    null; equal rows give equal rows; an empty table gives no rows. Texts are counted whole.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts_of = counter(vocabulary).count
        for batch in batches:
            texts = batch.column("text")
            n_bytes = np.diff(text_bytes(texts)[1]).astype(np.int64)
            tokens = np.fromiter((counts_of(t) if t else 0 for t in texts.to_pylist()),
                                 np.int64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(tokens),
                 pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
