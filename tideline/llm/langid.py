"""Language identification: unigram piece models that sum over all segmentations of a word."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import slices, widen
from tideline.session import settle

#: Runs of letters and of number signs that are no digits.
RUNS = re.compile(r"[^\W\d_]+")
#: Marks the start of a word in the vocabulary's pieces.
START = "▁"
#: Probability of a character that no piece covers, the same in every language.
UNKNOWN = 1e-7
#: Words whose scores a worker remembers.
REMEMBERED = 300_000


def words_in(text: str) -> list[str]:
    """Lower-cased runs of letters (Unicode categories L*)."""
    runs = RUNS.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


def vocabulary(path: str) -> dict[str, int]:
    """The pieces of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {piece: i for i, piece in enumerate(plain)}


class Lattice:
    """Every segmentation of words of one length into pieces; ``at[i, k]`` are the piece numbers of characters i..i+k."""

    def __init__(self, words: Sequence[str], pieces: dict[str, int], longest: int):
        self.length = len(words[0]) + 1
        none = len(pieces)  # row of probability 0; the next row is an unknown character
        find = pieces.get
        marked = [START + w for w in words]
        self.at: dict[tuple[int, int], np.ndarray] = {}
        for i in range(self.length):
            for k in range(1, min(longest, self.length - i) + 1):
                missing = none + 1 if k == 1 else none
                ids = np.fromiter((find(w[i : i + k], missing) for w in marked), dtype=np.int32, count=len(marked))
                if (ids != none).any():
                    self.at[i, k] = ids

    def forward(self, table: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Log probability (words, languages), and the scaled forward values with the log of their scales."""
        n = len(next(iter(self.at.values())))
        values = [np.ones((n, table.shape[1]))]
        scales = [np.zeros((n, 1))]
        for t in range(1, self.length + 1):
            low = max(0, t - longest)
            base = scales[t - 1]
            total = np.zeros_like(values[0])
            for i in range(low, t):
                ids = self.at.get((i, t - i))
                if ids is not None:
                    total += values[i] * table[ids] * np.exp(scales[i] - base)
            top = np.maximum(total.max(axis=1, keepdims=True), 1e-300)
            values.append(total / top)
            scales.append(base + np.log(top))
        return np.log(np.maximum(values[-1], 1e-300)) + scales[-1], values, scales

    def expected(self, table: np.ndarray, counts: np.ndarray, longest: int, out: np.ndarray) -> None:
        """Add to ``out`` (pieces, 1) how often each piece is used, over all segmentations of counted words."""
        log_z, values, scales = self.forward(table, longest)
        n = len(counts)
        back = [np.zeros((n, 1))] * self.length + [np.ones((n, 1))]
        lift = [np.zeros((n, 1))] * (self.length + 1)  # log of the scale of `back`
        for t in range(self.length - 1, -1, -1):
            base = lift[t + 1]
            total = np.zeros((n, 1))
            for k in range(1, min(longest, self.length - t) + 1):
                ids = self.at.get((t, k))
                if ids is not None:
                    total = total + back[t + k] * table[ids] * np.exp(lift[t + k] - base)
            top = np.maximum(total, 1e-300)
            back[t], lift[t] = total / top, base + np.log(top)
        for (i, k), ids in self.at.items():
            share = values[i] * table[ids] * back[i + k] * np.exp(scales[i] + lift[i + k] - log_z)
            np.add.at(out, ids, share * counts[:, None])


def by_length(words: Sequence[str]) -> Iterator[np.ndarray]:
    """Places of words of the same length, in groups of bounded size."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
        step = max(1, 1_000_000 // int(size[group[0]] + 1) // 16)
        for at in range(0, len(group), step):
            yield group[at : at + step]


def _count_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) over all texts, counted in each batch before the shuffle."""
    kept = docs.select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts: dict[tuple[str, str], int] = {}
                for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word in words_in(value or ""):
                        counts[name, word] = counts.get((name, word), 0) + 1
                if counts:
                    names, words = zip(*counts)
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(words), pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])

    return kept.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(
    docs: DataFrame,
    pieces: dict[str, int],
    *,
    text: str = "text",
    lang: str = "lang",
    order: str | Column = "doc_id",
    sample_docs: int = 1500,
    rounds: int = 2,
    smooth: float = 0.05,
) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces + 2, languages), by expectation maximisation.

    Learns from about ``sample_docs`` whole documents of each non-null language, picked by a hash of
    ``order`` at a rate set from counts over all rows. What reaches the driver is one number for
    each piece of the vocabulary and language.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((len(pieces) + 2, 0))
    rate = F.coalesce(*[F.when(F.col(lang) == name, F.lit(min(1.0, sample_docs / sizes[name]))) for name in langs])
    place = F.pmod(F.xxhash64(F.lit("langid"), order), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = settle(_count_words(known.where(place < rate), text, lang), "lang-words")
    longest = max(map(len, pieces))
    table = np.full((len(pieces) + 2, len(langs)), 1.0 / len(pieces))
    table[len(pieces)], table[len(pieces) + 1] = 0.0, UNKNOWN
    vocab = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(table)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros_like(now.value)
            for batch in batches:
                names, words = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                n = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                column = np.array([langs.index(x) for x in names])
                for c in np.unique(column):
                    mine = np.flatnonzero(column == c)
                    chosen = [words[i] for i in mine]
                    for group in by_length(chosen):
                        Lattice([chosen[i] for i in group], vocab.value, longest).expected(now.value[:, c : c + 1], n[mine[group]], longest, out[:, c : c + 1])
            piece, c = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(c), pa.array(out[piece, c])], names=["piece", "c", "n"])

        used = counts.mapInArrow(expect, "piece long, c long, n double").groupBy("piece", "c").agg(F.sum("n").alias("n")).collect()
        fresh = np.full(table.shape, smooth)
        for r in used:
            fresh[r.piece, r.c] += r.n
        fresh[len(pieces) :] = 0
        table = fresh / fresh.sum(axis=0)
        table[len(pieces) + 1] = UNKNOWN
    return langs, table


class Scorer:
    """Log probabilities of words in every language; remembers words."""

    def __init__(self, pieces: dict[str, int], table: np.ndarray):
        self.pieces, self.table = pieces, table
        self.longest = max(map(len, pieces))
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, table.shape[1]))

    def score(self, words: list[str]) -> np.ndarray:
        if len(self.place) > REMEMBERED:
            self.place, self.known = {}, self.known[:0]
        new = list(set(words) - self.place.keys())
        if new:
            made = np.empty((len(new), self.table.shape[1]))
            for group in by_length(new):
                made[group] = Lattice([new[i] for i in group], self.pieces, self.longest).forward(self.table, self.longest)[0]
            self.place.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.known = np.concatenate((self.known, made))
        return self.known[np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))]


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray], pieces: dict[str, int], *, text: str = "text", steady_words: float = 20.0, carry: Sequence[str] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the posterior of the predicted language under equal priors.

    A text's log probability in a language is the sum over its lower-cased letter runs, each summed
    over all segmentations into pieces. For the posterior it counts as at most ``steady_words``
    words, so that long texts do not all score 1. Null texts, texts without a letter, and any text
    when no language was learnt are ``und`` with score 0. Of equal languages the first in
    alphabetical order wins. Rows stay where they are; repeated rows score alike; columns already
    called lang_pred and score are replaced.
    """
    langs, table = model
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((pieces, table))

    def make():
        scorer = Scorer(*shared.value) if langs else None

        def work(texts):
            found = [words_in(t) if t and scorer else [] for t in texts]
            size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            out, sure = ["und"] * len(found), [0.0] * len(found)
            some = np.flatnonzero(size)
            if len(some):
                each = scorer.score([w for words in found for w in words])
                total = np.add.reduceat(each, np.concatenate(([0], np.cumsum(size[some])))[:-1], axis=0)
                best = total.argmax(axis=1)
                calm = total * (np.minimum(size[some], steady_words) / size[some])[:, None]
                odds = np.exp(calm - calm.max(axis=1, keepdims=True))
                for i, b, p in zip(some.tolist(), best.tolist(), (odds / odds.sum(axis=1, keepdims=True)).max(axis=1).tolist()):
                    out[i], sure[i] = langs[b], p
            return out, sure

        return work

    return widen(docs, text, "lang_pred string, score double", make, carry)
