"""Language identification by segmentation-marginalised unigrams.

Every language gives each piece of a fixed public vocabulary a probability. A word's probability is
the sum over all its segmentations into pieces of the product of the piece probabilities, found by a
forward pass over the word; a text's is the product over its words. All pieces of letters in the
vocabulary are used and words of any length are scored whole: the pass hands on the sums for as many
ends as the longest piece has letters, scaled so that nothing is lost to small numbers. Piece
probabilities are learned by expectation maximisation, one Spark job a round: a forward and a backward
pass give the expected number of uses of each piece. All passes run over many distinct words at once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from studyloom.llm.words import drop_kept, kept, mix, slices
from studyloom.session import durable

MARK = "▁"
#: The classifier is fitted on at most so many documents of each language, by hash of doc_id.
FIT_DOCUMENTS = 500
ROUNDS = 3
#: A sample of so many documents may be sent to every executor.
SMALL_SAMPLE = 100_000
#: Words kept per worker; others are scored again when they come up in a later batch.
KEPT_WORDS = 250_000
#: Letters (words times the longest of them) that are passed over together.
TOGETHER = 400_000
#: Ends after which sums are scaled.
SCALED = 8
#: Letters from which on a word is passed over alone, in stretches that hand on the sums of the last
#: ends; the fit counts the pieces of such a word by stretches.
LONG = 4096
UNDECIDED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words (rows, filled with 0) and their lengths."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    out = np.zeros((len(words), int(lengths.max(initial=1))), dtype=np.uint64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out, lengths


def _extend(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (hashes + codes + np.uint64(1)) * _BASE


@dataclass(frozen=True)
class Vocabulary:
    """Hashes of the lower-cased pieces of letters, sorted, and the letters of the longest."""

    hashes: np.ndarray
    longest: int
    filter: np.ndarray  # one flag per upper 20 bits of a hash

    @property
    def size(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, or -1."""
        out = np.full(hashes.shape, -1, dtype=np.int32)
        maybe = np.nonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
        some = hashes[maybe]
        at = np.minimum(np.searchsorted(self.hashes, some), max(self.size - 1, 0))
        out[maybe] = np.where(self.hashes[at] == some, at, -1) if self.size else -1
        return out


def piece_vocabulary(path: str) -> Vocabulary:
    """The pieces of letters in a public vocabulary file, all of them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    kept = sorted(p for p in pieces if p and all(c.isalpha() for c in p.removeprefix(MARK)))
    codes, lengths = _codes(kept)
    hashes = np.zeros(len(kept), dtype=np.uint64)
    for t in range(codes.shape[1]):
        live = lengths > t
        hashes[live] = _extend(hashes[live], codes[live, t])
    hashes = np.unique(mix(hashes))
    flags = np.zeros(1 << 20, dtype=bool)
    flags[(hashes >> np.uint64(44)).astype(np.int64)] = True
    return Vocabulary(hashes, int(lengths.max(initial=1)), flags)


class Lattice:
    """The pieces of many words: by end and number of letters, the words that have one there.

    A single letter is always a piece; a letter that the vocabulary lacks is piece `size`.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        codes, self.lengths = _codes(words)
        self.width, self.longest = codes.shape[1], vocabulary.longest
        #: at[end]: (letters, words, pieces) of the pieces that end there
        self.at: list[list[tuple[int, np.ndarray, np.ndarray]]] = [
            [] for _ in range(self.width + 1)]
        hashes = np.zeros((len(words), self.width), dtype=np.uint64)  # of pieces by their start
        for n in range(1, min(self.longest, self.width) + 1):
            starts = self.width - n + 1
            hashes = _extend(hashes[:, :starts], codes[:, n - 1:])
            found = vocabulary.find(mix(hashes))
            if n == 1:
                found[found < 0] = vocabulary.size
            found[np.arange(n, self.width + 1)[None, :] > self.lengths[:, None]] = -1
            start, word = np.nonzero(found.T >= 0)
            cuts = np.searchsorted(start, np.arange(starts + 1))
            piece = found[word, start]
            for k in range(starts):
                if cuts[k] < cuts[k + 1]:
                    part = slice(cuts[k], cuts[k + 1])
                    self.at[k + n].append((n, word[part], piece[part]))

    def _scale(self, sums: np.ndarray, scales: np.ndarray, first: int, last: int,
               whole: slice) -> None:
        """Divide the sums at ends first..last, which later steps use, by their largest."""
        top = sums[:, first:last + 1].max(axis=1)
        top[top <= 0] = 1.0
        sums[:, first:last + 1] /= top[:, None]
        scales[:, whole] += np.log(top)[:, None]

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums over all segmentations up to each end, for probabilities p (pieces x models).

        Returns the sums (words x ends x models), the logarithms of the factors taken out of them,
        and the logarithm of each word's probability (words x models).
        """
        n_words, models = len(self.lengths), p.shape[1]
        sums = np.zeros((n_words, self.width + 1, models))
        scales = np.zeros((n_words, self.width + 1, models))
        sums[:, 0] = 1.0
        for end in range(1, self.width + 1):
            for n, word, piece in self.at[end]:
                sums[word, end] += sums[word, end - n] * p[piece]
            if end % SCALED == 0 and end < self.width:
                first = max(0, end - self.longest + 1)
                self._scale(sums, scales, first, end, slice(first, None))
        rows = np.arange(n_words)
        total = (np.log(np.maximum(sums[rows, self.lengths], 1e-300))
                 + scales[rows, self.lengths])
        return sums, scales, total

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over words that occur `counts` times."""
        p = p.reshape(-1, 1)
        alpha, before, total = self.forward(p)
        beta, after = np.zeros_like(alpha), np.zeros_like(before)
        beta[np.arange(len(self.lengths)), self.lengths] = 1.0
        uses = np.zeros(len(p))
        for end in range(self.width, 0, -1):
            for n, word, piece in self.at[end]:
                step = p[piece] * beta[word, end]
                scale = np.exp(before[word, end - n] + after[word, end] - total[word])
                share = alpha[word, end - n] * step * scale * counts[word][:, None]
                np.add.at(uses, piece, share[:, 0])
                beta[word, end - n] += step
            if end % SCALED == 0:
                first = max(0, end - self.longest)
                self._scale(beta, after, first, end - 1, slice(None, end))
        return uses


def lattices(words: list[str], vocabulary: Vocabulary) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Lattices over the marked words, those of like length together, with their numbers."""
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        fits = np.arange(1, len(order) - at + 1) * sizes[order[at:]] <= TOGETHER
        to = at + max(1, int(fits.argmin()) if not fits.all() else len(fits))
        chunk = order[at:to]
        yield chunk, Lattice([MARK + words[i] for i in chunk.tolist()], vocabulary)
        at = to


def letters_of(text: str) -> list[str]:
    """Lower-cased runs of letters; numeric signs count only beside a letter."""
    words = _LETTERS.findall(text.lower())
    return words if text.isascii() else [
        w for w in words if w.isalpha() or any(map(str.isalpha, w))]


@dataclass
class Model:
    languages: list[str]
    vocabulary: Vocabulary
    pieces: np.ndarray  # languages x (vocabulary + 1)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probabilities, words x languages."""
        out = np.zeros((len(words), len(self.languages)))
        p = np.ascontiguousarray(self.pieces.T)
        usual = np.array([k for k, w in enumerate(words) if len(w) < LONG], dtype=np.int64)
        for chunk, lattice in lattices([words[k] for k in usual.tolist()], self.vocabulary):
            out[usual[chunk]] = lattice.forward(p)[2]
        for k, word in enumerate(words):
            if len(word) >= LONG:
                out[k] = self.long_score(word, p)
        return out

    def long_score(self, word: str, p: np.ndarray) -> np.ndarray:
        """Log probabilities of one long word: stretch by stretch, with the last sums carried on."""
        codes, longest = _codes([MARK + word])[0][0], self.vocabulary.longest
        last = [np.ones(p.shape[1])]  # sums up to the last ends, the newest at the end
        scale = np.zeros(p.shape[1])
        for first in range(0, len(codes), LONG):
            begin, end = max(0, first - longest + 1), min(len(codes), first + LONG)
            hashes = np.zeros(end - begin, dtype=np.uint64)
            found = []
            for n in range(1, min(longest, end - begin) + 1):
                hashes = _extend(hashes[:end - begin - n + 1], codes[begin + n - 1:end])
                pieces = self.vocabulary.find(mix(hashes))
                if n == 1:
                    pieces[pieces < 0] = self.vocabulary.size
                found.append(pieces.tolist())
            for to in range(first + 1, end + 1):
                total = np.zeros(p.shape[1])
                for n in range(1, min(len(last), len(found)) + 1):
                    piece = found[n - 1][to - n - begin] if to - n >= begin else -1
                    if piece >= 0:
                        total += last[-n] * p[piece]
                last.append(total)
                del last[:-longest]
                if to % SCALED == 0:
                    top = np.maximum(np.max(last, axis=0), 1e-300)
                    last = [x / top for x in last]
                    scale += np.log(top)
        return np.log(np.maximum(last[-1], 1e-300)) + scale


def _word_counts(sample: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts of `sample` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in slices(batch):
                words: Counter = Counter()
                for lang, text in zip(part.column("lang").to_pylist(),
                                      part.column("text").to_pylist()):
                    words.update((lang, w[at:at + LONG]) for w in letters_of(text)
                                 for at in range(0, len(w), LONG))
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in words], pa.string()),
                    pa.array([k[1] for k in words], pa.string()),
                    pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])

    return sample.mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))


def _expected_uses(counts: DataFrame, vocabulary: Vocabulary,
                   pieces: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One round over all words: expected uses of every piece, by language."""

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            words = batch.column("word").to_pylist()
            times = batch.column("n").to_numpy().astype(np.float64)
            for lang in sorted(set(langs.tolist())):
                own = np.flatnonzero(langs == lang)
                total = np.zeros(vocabulary.size + 1)
                for chunk, lattice in lattices([words[i] for i in own.tolist()], vocabulary):
                    total += lattice.expected(pieces[lang], times[own[chunk]])
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                    pa.array(total[used])], names=["lang", "piece", "uses"])

    rows = counts.mapInArrow(uses, "lang string, piece int, uses double").groupBy(
        "lang", "piece").agg(F.sum("uses").alias("uses")).toArrow()  # as large as the model
    langs = np.array(rows.column("lang").to_pylist(), dtype=object)
    number, value = rows.column("piece").to_numpy(), rows.column("uses").to_numpy()
    out = {lang: np.zeros(vocabulary.size + 1) for lang in pieces}
    for lang, total in out.items():
        own = langs == lang
        total[number[own]] = value[own]
    return out


def fit(docs: DataFrame, vocabulary_path: str, per_language: int = FIT_DOCUMENTS,
        rounds: int = ROUNDS) -> Model:
    """Learn piece probabilities from `docs` (doc_id, text, lang).

    Uses at most `per_language` doc_ids of each non-null lang, those with the smallest hash, with
    all their words. Rows without a doc_id are not used. Without labelled text the model has no
    language.
    """
    order = Window.partitionBy("_lid_lang").orderBy("_lid_hash", "_lid_id")
    labelled = docs.dropna(subset=["doc_id", "lang", "text"]).select(
        F.col("doc_id").cast("long").alias("_lid_id"), F.col("lang").cast("string")
        .alias("_lid_lang"), F.xxhash64("doc_id").alias("_lid_hash"), "text")
    # chosen by narrow rows, so that no text but those of the sample leaves its task
    chosen = durable(labelled.drop("text").withColumn(
        "_lid_place", F.row_number().over(order)).filter(F.col("_lid_place") <= per_language)
        .select("_lid_id", "_lid_lang", "_lid_hash").distinct())
    sample = labelled.join(
        F.broadcast(chosen) if chosen.count() <= SMALL_SAMPLE else chosen,
        (labelled["_lid_id"] == chosen["_lid_id"])
        & (labelled["_lid_lang"] == chosen["_lid_lang"]), "left_semi").select(
        F.col("_lid_lang").alias("lang"), "text")
    counts = durable(_word_counts(sample))
    vocabulary = piece_vocabulary(vocabulary_path)
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    n = vocabulary.size + 1
    pieces = {lang: np.full(n, 1.0 / n) for lang in languages}
    for _ in range(rounds if languages else 0):
        uses = _expected_uses(counts, vocabulary, pieces)
        pieces = {lang: (u + 0.05) / (u.sum() + 0.05 * n) for lang, u in uses.items()}
    return Model(languages, vocabulary,
                 np.array([pieces[k] for k in languages]).reshape(len(languages), n))


class Scorer:
    """Scores texts; the log probabilities of words seen are kept in a bounded table."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.rows = np.empty((KEPT_WORDS, len(model.languages)), dtype=np.float32)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities (texts x languages) and numbers of words."""
        words = [letters_of(t) if t else [] for t in texts]
        seen = set()
        for w in words:
            seen.update(w)
        new = sorted(seen.difference(self.known))
        room = max(0, KEPT_WORDS - len(self.known))
        fresh = self.model.word_scores(new).astype(np.float32)
        first = len(self.known)
        for k, w in enumerate(new[:room]):
            self.known[w] = first + k
        self.rows[first:first + min(room, len(new))] = fresh[:room]
        table, place = self.rows, self.known
        if len(new) > room:  # the rest serves this batch only
            table = np.concatenate([self.rows, fresh[room:]])
            place = {w: KEPT_WORDS + k for k, w in enumerate(new[room:])}
        out = np.zeros((len(texts), len(self.model.languages)))
        known = self.known.get
        for i, w in enumerate(words):
            if w:
                at = list(map(known, w))
                if place is not self.known:
                    at = [place[x] if a is None else a for x, a in zip(w, at)]
                out[i] = table[at].sum(axis=0, dtype=np.float64)
        return out, np.array([len(w) for w in words])


def _scorer(model: Model) -> Scorer:
    key = hashlib.blake2b(model.pieces.tobytes() + repr(model.languages).encode()).digest()
    return kept("scorer", key, lambda: Scorer(model))


def predict(docs: DataFrame, model: Model, *columns: Column, rows: int = 600) -> DataFrame:
    """`columns` of `docs`, _lid_pred (language) and _lid_score.

    _lid_score is the probability of the language given the text, all languages alike beforehand and
    the words weighted down to the square root of their number, or it would always be 1.
    A text without letters, or null, is `und` with score 0; so is every text if the model has
    no language. Ties go to the language that sorts first. Texts are scored whole.
    """
    rows_in = docs.select(*columns, F.col("text").alias("_lid_text"))
    names = rows_in.columns[:-1]
    schema = rows_in.drop("_lid_text").schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _scorer(model) if model.languages else None
        for whole in batches:
            for at in range(0, len(whole), rows):
                batch = whole.slice(at, rows)
                texts = batch.column("_lid_text").to_pylist()
                if tool is None:
                    lang, score = [UNDECIDED] * len(texts), np.zeros(len(texts))
                else:
                    logs, n_words = tool.scores(texts)
                    logs = logs / np.sqrt(np.maximum(n_words, 1))[:, None]
                    best = logs.argmax(axis=1)
                    chance = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    lang = [model.languages[b] if n else UNDECIDED
                            for b, n in zip(best.tolist(), n_words.tolist())]
                    score = np.where(n_words > 0, chance, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in names]
                    + [pa.array(lang, pa.string()), pa.array(score)],
                    names=[*names, "_lid_pred", "_lid_score"])

    return rows_in.mapInArrow(run, f"{schema}, _lid_pred string, _lid_score double")


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text leaves remainder 1 by 3; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, vocabulary_path: str, **limits: int) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; fitted on rows that are not held out.

    Needs doc_id, text and lang; other columns are ignored. A null doc_id counts as not held out. A
    null text, or one without a letter, is `und` with score 0; equal rows give equal rows; texts and
    words of any length are scored whole; an empty table gives no rows.
    """
    model = fit(docs.filter(~held_out(F.col("doc_id"))), vocabulary_path, **limits)
    return predict(docs, model, F.col("doc_id").cast("long").alias("doc_id"),
                   held_out(F.col("doc_id")).alias("held_out")).withColumnsRenamed(
        {"_lid_pred": "lang_pred", "_lid_score": "score"})


def keep_identified(docs: DataFrame, vocabulary_path: str, least: float = 0.5) -> DataFrame:
    """Rows of `docs` with letters whose language is found with a score of `least` or more.

    Null and empty texts, and texts without a letter, go. Rows are judged one by one, so repeated
    ones stay or go together; all columns stay as they are; an empty table gives no rows.
    """
    model = fit(docs.filter(~held_out(F.col("doc_id"))), vocabulary_path)
    found = predict(docs, model, *[F.col(c) for c in docs.columns])
    return found.filter((F.col("_lid_pred") != UNDECIDED) & (F.col("_lid_score") >= least)).select(
        *docs.columns)
