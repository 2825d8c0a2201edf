"""Line dedup: repeated runs found by winnowed hashes of lines, deleted wherever they come later.

A line is laid from every word on, ``LINE`` words long, so a passage shares its lines with its repeat wherever it
begins and ends and however either text is wrapped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import blocks
from tideline.llm.arrow import free, values
from tideline.llm.words import mix, spaced
from tideline.session import discard, settle

#: Words of a line.
LINE = 9
#: Words are what stands between ASCII white space.
SPACE = b" \t\n\v\f\r"
#: Odd multipliers of the two hashes of a run of words.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


class Runs:
    """Two 64-bit hashes of any run of the words of many texts, from running sums."""

    def __init__(self, texts: list[str | None]):
        of, self.edge = spaced(texts)
        self._sums, self._back = [], []
        for salt, base in enumerate(BASES):
            words = mix(of + np.uint64(salt * BASES[0] & (1 << 64) - 1))
            power = np.full(len(words) + 1, base, np.uint64)
            power[0] = 1
            np.cumprod(power, out=power)
            self._sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power[:-1], dtype=np.uint64))))
            inverse = np.full(len(words) + 1, pow(base, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            self._back.append(np.cumprod(inverse, out=inverse))

    def hash(self, begin: np.ndarray, end: np.ndarray, which: int, tag: np.ndarray | int = 0) -> np.ndarray:
        """Hashes of the words from ``begin`` to before ``end``, joined with a small number."""
        whole = (self._sums[which][end] - self._sums[which][begin]) * self._back[which][begin]
        return mix(mix(whole) + np.asarray(tag, np.uint64)).view(np.int64)


    def lines(self, length: int) -> np.ndarray:
        """Hashes of the words from each one on, ``length`` of them, also across texts."""
        sums = self._sums[0]
        return mix((sums[length:] - sums[:-length]) * self._back[0][:-length]).view(np.int64)


def fingerprints(runs: Runs, least: int, line: int = LINE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the smallest line hash of each ``least`` words of a text begins, its text, and the hashes of all lines."""
    total, width = int(runs.edge[-1]), least - line + 1
    if total < least:
        none = np.zeros(0, np.int64)
        return none, none, none
    hashes = runs.lines(line)
    # The smallest of as many hashes as a power of two from each one on, and which it is; then of two such that overlap.
    smallest, best, size = hashes, np.arange(len(hashes)), 1
    while size < width:
        step = min(size, width - size)
        less = smallest[step:] < smallest[:-step]
        smallest = np.where(less, smallest[step:], smallest[:-step])
        best = np.where(less, best[step:], best[:-step])
        size += step
    sizes = np.diff(runs.edge)
    inside = np.repeat(runs.edge[1:], sizes)[: len(best)] - np.arange(len(best)) >= least
    at = best[inside]
    at = at[np.concatenate((at[:1] >= 0, at[1:] != at[:-1]))]
    return at, np.repeat(np.arange(len(sizes)), sizes)[at], hashes


#: Columns of the fingerprints of a document.
PRINT = {"h": np.int64, "c": np.int64, "p": np.int32, "e": np.int32}
#: Columns of its runs of words.
WINDOW = {"w": np.int64, "x": np.int64, "first": np.int32}


def _measure(df: DataFrame, least: int) -> DataFrame:
    """Fingerprints of each document (``id``, ``k``): ``h`` at word ``p``, with a hash ``c`` of the words around.

    Those words, from ``p - (least - LINE)`` to before ``e``, hold every run of ``least`` words with the line in it.
    """
    reach = least - LINE

    def make(part: pa.RecordBatch) -> tuple[np.ndarray, list]:
        runs = Runs(values(part.column("text")))
        at, row, hashes = fingerprints(runs, least)
        base = runs.edge[row]
        low, high = np.maximum(at - reach, base), np.minimum(at + least, runs.edge[row + 1])
        shape = (at - low) * (2 * least) + (high - low)
        # The smallest hashes are much alike; mixed again they spread over all buckets.
        return row, [mix(hashes[at].view(np.uint64)).view(np.int64), runs.hash(low, high, 1, shape), at - base, high - base]

    return blocks.keep_rows(df.select("id", "k", "text"), ["id", "k"], make, PRINT, "line-hashes")


def _windows(marked: DataFrame, least: int) -> DataFrame:
    """Rows (id, k, w, x, first): each run of ``least`` words that holds a line beginning at one of ``points``."""

    def make(part: pa.RecordBatch) -> tuple[np.ndarray, list]:
        runs = Runs(values(part.column("text")))
        points = part.column("points")
        row = np.repeat(np.arange(len(part)), pc.list_value_length(points).to_numpy(zero_copy_only=False))
        at = points.flatten().to_numpy(zero_copy_only=False) + runs.edge[row]
        first = (at[:, None] - np.arange(least - LINE + 1)).ravel()
        row = np.repeat(row, least - LINE + 1)
        first = np.unique(first[(first >= runs.edge[row]) & (first + least <= runs.edge[row + 1])])
        row = np.searchsorted(runs.edge, first, side="right") - 1
        return row, [*(runs.hash(first, first + least, which) for which in (0, 1)), first - runs.edge[row]]

    return blocks.keep_rows(marked.select("id", "k", "text", "points"), ["id", "k"], make, WINDOW, "line-windows")


def keep(text: str, runs: Sequence[Sequence[int]]) -> tuple[str, int]:
    """``text`` without the words of ``runs`` (numbers of words, both ends included, in order), and how many were cut out.

    White space on both sides of a cut becomes a line end if one stood there or in what was cut, else one space.
    """
    raw = text.encode()
    byte = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff((byte != 32) & ((byte < 9) | (byte > 13)), prepend=False, append=False))
    begin, end = edges[::2].tolist(), edges[1::2].tolist()
    out, at = bytearray(), 0
    for a, b in runs:
        out += raw[at : begin[a]]
        at = begin[b + 1] if b + 1 < len(begin) else len(raw)
        line = b"\n" in raw[begin[a] : at]
        while out and out[-1] in SPACE:
            line |= out.pop() == 10
        if out and at < len(raw):
            out += b"\n" if line else b" "
    return (bytes(out) + raw[at:]).decode(), sum(b - a + 1 for a, b in runs)


def dedup_lines(df: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 25) -> DataFrame:
    """``df`` with later repeated runs of words cut out of ``text``, plus ``removed_words`` and ``removed_runs``.

    Words are what stands between ASCII white space, lower-cased. A run of ``least`` words (at least ``LINE``) whose first
    occurrence in the table, in the order of ``id``, does not overlap it is deleted; longer runs are
    covered by such ones. So a passage goes wherever it begins and ends, its first occurrence stays,
    and shorter repeats stay. A run does not count as the repeat of one that it overlaps.

    Lines of ``LINE`` words begin at every word. The smallest line hash of each run of ``least`` words
    is a fingerprint, so equal runs share one. Around a repeated fingerprint a match is extended both
    ways to all words that such a run can reach: where those are repeated too they are deleted at
    once, and where they differ (at the ends of a passage) each run of ``least`` words is compared by
    itself. A match takes 128 bits: hashes of the line and of the words around it, or two of a run. What is met more than once is found by counts
    of packed hashes, each sent once for each slice of texts that holds it; only that much becomes rows. First places are looked up by
    aggregates that add up before the shuffle; the joins that spread the first places can be split.

    A null text stays null, an empty one empty, with nothing removed; a long one is one row of numbers while it is
    measured. Rows equal in id and text are one document and get the same result. Null ids come
    first. Columns of ``df`` called removed_words and removed_runs are replaced; all others are carried along.
    """
    if least < LINE:
        raise ValueError(f"least must be {LINE} words or more")
    key = F.xxhash64(F.col(id), F.col(text))
    source = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), key.alias("k"))
    prints = _measure(source, least)

    # Rows equal in id and text count as repeats here; they are no places apart, so nothing of theirs is cut.
    def ends(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
        """Keys met more than once, with their first place."""
        found = rows.groupBy(*keys).agg(F.min(F.struct("id", "k", place)).alias("a"), F.count("*").alias("n")).where("n > 1")
        found = found.select(*keys, F.col("a.id").alias("id1"), F.col("a.k").alias("k1"), F.col(f"a.{place}").alias("at1"))
        return settle(found, "line-firsts")

    def repeated(rows: DataFrame, name: str) -> DataFrame:
        """Rows whose ``name`` is met more than once; plain numbers add up without sorting."""
        return rows.join(settle(rows.groupBy(name).count().where("count > 1").select(name), "line-repeated"), name, "left_semi")

    def apart(place: str, width) -> F.Column:
        other = (F.col("k") != F.col("k1")) | ~F.col("id").eqNullSafe(F.col("id1"))
        return F.col("k1").isNotNull() & (other | (F.col(place) - F.col("at1") >= width))

    near = settle(blocks.repeats(prints, "h", PRINT), "line-near")
    discard(prints)
    low = F.greatest(F.col("p") - (least - LINE), F.lit(0))
    firsts = ends(near, ["h", "c"], "p")
    judged = near.join(firsts, ["h", "c"], "left").select("id", "k", "h", "p", low.alias("first"), "e", apart("p", F.col("e") - low).alias("later"))
    open_only = {name: F.when(~F.col("later"), F.col(name)) for name in ("h", "p")}
    judged = settle(judged.withColumns(open_only), "line-judged")
    discard(near, firsts)
    points = repeated(judged.where(~F.col("later")), "h").groupBy("id", "k").agg(F.collect_set("p").alias("points"))

    def same(left: DataFrame, right: DataFrame) -> F.Column:
        return (left["k"] == right["k"]) & left["id"].eqNullSafe(right["id"])

    points = settle(points, "line-points")
    marked = source.join(points, same(source, points)).select(source["id"], source["k"], "text", "points")
    windows = _windows(marked, least)
    runs = settle(blocks.repeats(windows, "w", WINDOW), "line-runs")
    discard(windows, points)
    later = runs.join(ends(runs, ["w", "x"], "first"), ["w", "x"]).where(apart("first", F.lit(least)))
    covered = judged.where("later").select("id", "k", "first", (F.col("e") - 1).alias("last"))
    cuts = covered.unionByName(later.select("id", "k", "first", (F.col("first") + (least - 1)).alias("last")))

    kept = df.drop("removed_words", "removed_runs")
    k, i, spans, own = free(df, "k"), free(df, "i"), free(df, "spans"), free(df, "own")
    found = cuts.groupBy(F.col("id").alias(i), F.col("k").alias(k)).agg(F.collect_set(F.shiftleft(F.col("first").cast("long"), 32) + F.col("last")).alias(spans))
    joined = kept.withColumn(own, key).join(found, (F.col(own) == F.col(k)) & F.col(id).eqNullSafe(F.col(i)), "left").drop(own, k, i)
    return _delete(joined, text, spans).select(*kept.columns, "removed_words", "removed_runs")


def _merged(cuts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of words from sorted cuts (first << 32 | last); those that touch are one."""
    first, last = cuts >> 32, np.maximum.accumulate(cuts & 0xFFFFFFFF)
    new = np.flatnonzero(first[1:] > last[:-1] + 1) + 1
    return list(zip(first[np.concatenate(([0], new))].tolist(), last[np.concatenate((new - 1, [len(last) - 1]))].tolist()))


def _delete(joined: DataFrame, text: str, runs: str) -> DataFrame:
    names = joined.columns
    out = joined.drop(runs).withColumns({"removed_words": F.lit(0).cast("long"), "removed_runs": F.lit(0).cast("long")}).schema
    for field in out.fields:
        field.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, runs_at = names.index(text), names.index(runs)
        for batch in batches:
            texts, cuts, removed, count = batch.column(at), batch.column(runs_at), np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            numbers, size = cuts.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(cuts).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            hit = (size > 0) & pc.is_valid(texts).to_numpy(zero_copy_only=False)
            new = values(texts.filter(pa.array(hit)))
            for j, i in enumerate(np.flatnonzero(hit).tolist()):
                spans = _merged(np.sort(numbers[ends[i] - size[i] : ends[i]]))
                new[j], removed[i] = keep(new[j], spans)
                count[i] = len(spans)
            texts = pc.replace_with_mask(texts, pa.array(hit), pa.array(new, texts.type))
            columns = [texts if i == at else c for i, c in enumerate(batch.columns) if i != runs_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed), pa.array(count)], names=out.names)

    return joined.mapInArrow(run, out)
