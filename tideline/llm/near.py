"""Near-duplicates by Order MinHash with alignment of shared shingles, and the connected classes they form."""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import free, slices, widen
from tideline.llm.words import grams, hashed, labelled, mix
from tideline.session import settle


def firsts(shingles: np.ndarray) -> np.ndarray:
    """The first occurrence of each shingle, in text order."""
    return shingles[np.sort(np.unique(shingles, return_index=True)[1])]


def sketch(shingles: np.ndarray, bands: int, minima: int) -> np.ndarray:
    """For each band: its ``minima`` smallest distinct shingles, in the order they first stand in, as one hash.

    A text that repeats shingles has as many hashes again over its occurrence-labelled ones.
    """
    values = firsts(shingles)
    out = _sketch(values, bands, minima)
    if len(values) < len(shingles):
        out = np.unique(np.concatenate((out, _sketch(labelled(shingles), bands, minima))))
    return out


def _sketch(values: np.ndarray, bands: int, minima: int) -> np.ndarray:
    seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    take = min(minima, len(values))
    out = seeds.copy()
    if not take:
        return out[:0]
    step = max(1, 2_000_000 // len(values))  # bands at a time: bounded memory for long texts
    for at in range(0, bands, step):
        ranked = mix(values[None, :] ^ seeds[at : at + step, None])
        chosen = np.sort(np.argpartition(ranked, take - 1, axis=1)[:, :take], axis=1)
        for j in range(take):
            out[at : at + step] = mix(out[at : at + step] * np.uint64(0x9E3779B97F4A7C15) + values[chosen[:, j]])
    return out


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Distinct shingles matched in the same order within a band, over all distinct shingles of both.

    The t-th occurrence of a shingle can match the t-th occurrence of the other text at most
    ``(1 / threshold - 1)`` of the longer text away; the longest chain of matches with rising places
    on both sides is taken. Repeats take up places too, so first occurrences alone are aligned as well
    if that falls below the threshold, and the larger result counts. Never above the Jaccard similarity,
    and equal to it where nothing moved.
    """
    set_a, set_b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(set_a, set_b, assume_unique=True))
    union = len(set_a) + len(set_b) - shared
    if not union or shared < threshold * union:
        return shared / union if union else 1.0
    best = _aligned(labelled(a), labelled(b), a, threshold)
    if best < threshold * union and len(set_a) + len(set_b) < len(a) + len(b):
        fa, fb = firsts(a), firsts(b)
        best = max(best, _aligned(fa, fb, fa, threshold))
    return best / union


def _aligned(la: np.ndarray, lb: np.ndarray, a: np.ndarray, threshold: float) -> int:
    """How many distinct values of ``a`` the longest chain of equal ``la`` and ``lb`` within the band has."""
    order = np.argsort(lb, kind="stable")
    at = np.minimum(np.searchsorted(lb[order], la), len(lb) - 1)
    match = lb[order][at] == la
    i, j = np.flatnonzero(match), order[at[match]]
    near = np.abs(i - j) <= math.ceil((1 / threshold - 1) * max(len(la), len(lb))) + 1
    i, j = i[near], j[near]
    if len(j) > 1 and not (np.diff(j) > 0).all():
        tops: list[int] = []
        ends: list[int] = []
        back = [-1] * len(j)
        for n, place in enumerate(j.tolist()):
            at_top = bisect.bisect_left(tops, place)
            back[n] = ends[at_top - 1] if at_top else -1
            tops[at_top : at_top + 1] = [place]
            ends[at_top : at_top + 1] = [n]
        chain, n = [], ends[-1]
        while n >= 0:
            chain.append(n)
            n = back[n]
        i = i[chain]
    return len(np.unique(a[i]))


def _sketches(source: DataFrame, width: int, bands: int, minima: int) -> DataFrame:
    """Per row: content key ``c``, number of distinct shingles ``n``, band keys."""

    def make():
        def work(texts):
            words, edge = hashed(texts)
            keys, sizes, sketches = [], [], []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                keys.append(xxhash.xxh3_128_digest(words[a:b].tobytes()))
                shingles = grams(words[a:b], width)
                sizes.append(len(np.unique(shingles)))
                sketches.append(sketch(shingles, bands, minima).view(np.int64))
            return keys, sizes, sketches

        return work

    return widen(source, "text", "c binary, n int, bands array<long>", make, ["id", "k"])


def _shingles(source: DataFrame, width: int) -> DataFrame:
    def make():
        def work(texts):
            words, edge = hashed(texts)
            return ([grams(words[a:b], width).astype("<u8").tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())],)

        return work

    return widen(source, "text", "g binary", make, ["c"])


def _verify(pairs: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose aligned similarity reaches the threshold."""
    left, right = (payload.select(F.col("c").alias(x), F.col("g").alias("g" + x)) for x in "ab")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "ga", "gb")
    out = pairs.select("a", "b").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "gb"):
                sides = (part.column(c).to_pylist() for c in ("ga", "gb"))
                same = [aligned_similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), threshold) >= threshold for x, y in zip(*sides)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(same))

    return both.mapInArrow(run, out)


def components(edges: DataFrame) -> DataFrame:
    """(c, comp) for every end of an edge (a, b): the smallest node that it is connected to.

    Labels spread along the edges, then each label takes over the label of the node it names, which
    halves long paths; every round is written to the shared folder, so its lineage stays short.
    """
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = settle(both.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("c"), F.least("a", "l").alias("comp")), "near-labels")
    while True:
        heard = both.join(labels.withColumnsRenamed({"c": "a", "comp": "l"}), "a").groupBy("b").agg(F.min("l").alias("l"))
        spread = labels.join(heard.withColumnRenamed("b", "c"), "c").select("c", "comp", F.least("comp", "l").alias("new"))
        jump = labels.select(F.col("c").alias("new"), F.col("comp").alias("far"))
        fresh = settle(spread.join(jump, "new").select("c", F.least("new", "far").alias("next"), "comp"), "near-labels")
        changed = fresh.where(F.col("next") != F.col("comp")).limit(1).count()
        labels = fresh.select("c", F.col("next").alias("comp"))
        if not changed:
            return labels


def _rest(shared: DataFrame, labels: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """Pairs across components inside a bucket that a pivot did not decide: an exact prefix filter.

    In any order of all shingles, two texts above the threshold share one among the first
    ``n - ceil(threshold * n) + 1`` of each. Rare ones come first, so what many texts share (a
    common passage) makes no pairs.
    """
    placed = shared.select("key", "c", "n").join(labels, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    placed = settle(placed, "near-placed")
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where(F.col("x") != F.col("y")).select("key")
    docs = placed.join(settle(open_keys, "near-open"), "key", "left_semi").select("c", "n", "comp").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "g"):
                values = [np.unique(np.frombuffer(x, "<u8")).view(np.int64) for x in part.column("g").to_pylist()]
                at = pa.array(np.repeat(np.arange(len(values)), [len(v) for v in values]))
                flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in ("c", "n", "comp")), flat], names=["c", "n", "comp", "g"])

    full = docs.join(payload, "c").select("c", "n", "comp", "g")
    rows = settle(full.mapInArrow(run, "c binary, n int, comp binary, g long"), "near-shingles")
    often = settle(rows.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-often")
    ranked = rows.join(often, "g").groupBy("c", "n", "comp").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("s"))
    # Shingles that no other open text has come first and can't match: only their number counts.
    prefix = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - F.lit(1e-9)).cast("int") + 1
    alone = F.col("n") - F.size("s")
    head = ranked.select("c", "n", "comp", alone.alias("alone"), F.posexplode(F.slice("s", F.lit(1), F.greatest(prefix - alone, F.lit(0)))).alias("p", "e"))
    posts = settle(head.select("c", "n", "comp", F.col("e.g").alias("g"), (F.col("alone") + F.col("p")).alias("i")), "near-posts")
    mixed = posts.groupBy("g").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where(F.col("x") != F.col("y")).select("g")
    posts = settle(posts.join(mixed, "g", "left_semi"), "near-posts")
    a, b = posts.alias("a"), posts.alias("b")
    need = F.lit(threshold / (1 + threshold)) * (F.col("a.n") + F.col("b.n")) - F.lit(1e-6)
    can = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    on = (F.col("a.g") == F.col("b.g")) & (F.col("a.c") < F.col("b.c")) & (F.col("a.comp") != F.col("b.comp"))
    return a.join(b, on & _sizes_fit("a.n", "b.n", threshold) & (can >= need)).select(F.col("a.c").alias("a"), F.col("b.c").alias("b")).distinct()


def _sizes_fit(x: str, y: str, threshold: float):
    return F.least(x, y) >= F.lit(threshold) * F.greatest(x, y) - F.lit(1e-6)


def _classes(df: DataFrame, id: str, text: str, width: int, threshold: float, bands: int, minima: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, k, c) of all documents, and (c, comp, id, k) of all contents: component and its first document."""
    key = F.xxhash64(F.col(id), F.col(text))
    source = df.select(F.col(id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), key.alias("k"))
    rows = settle(_sketches(source, width, bands, minima), "near-rows")
    contents = settle(rows.groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k", "n", "bands")).alias("r")).select("c", "r.*"), "near-contents")
    keyed = contents.select("c", "n", F.explode("bands").alias("key"))
    sizes = settle(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "near-buckets")
    shared = settle(keyed.join(sizes, "key"), "near-shared")
    popular = settle(shared.groupBy("c").agg(F.sum("m").alias("pop")), "near-popular")
    # The most connected text of a bucket, which near copies of one original have nearest to it, stands for it.
    ranked = settle(shared.join(popular, "c").select("key", "c", "n", "pop"), "near-ranked")
    pivot = settle(ranked.groupBy("key").agg(F.max(F.struct("pop", "c", "n")).alias("p")).select("key", F.col("p.c").alias("a"), F.col("p.n").alias("an")), "near-pivots")
    fits = (F.col("a") != F.col("c")) & _sizes_fit("an", "n", threshold)
    pairs = ranked.join(pivot, "key").where(fits).select("a", F.col("c").alias("b")).distinct()
    texts = contents.join(popular, "c", "left_semi").select("c", "k")
    payload = source.join(texts, "k").dropDuplicates(["k"])
    payload = settle(_shingles(payload, width), "near-payload")
    edges = settle(_verify(pairs, payload, threshold), "near-links")
    labels = components(edges)
    more = settle(_verify(_rest(shared, labels, payload, threshold), payload, threshold), "near-links")
    if more.limit(1).count():
        labels = components(edges.union(more))
    placed = contents.select("c", "id", "k").join(labels, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    first = placed.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k")).alias("f"))
    placed = settle(placed.select("c", "comp").join(first, "comp").select("c", "comp", "f.id", "f.k"), "near-classes")
    return rows, placed


def near_classes(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 16, minima: int = 3
) -> DataFrame:
    """One row per row of ``df``: its id and ``class_id``, the smallest id of the class it belongs to.

    Texts with the same lower-cased words are copies. Two texts are linked if the similarity of
    their ``width``-word shingles, aligned in order (`aligned_similarity`), is at least
    ``threshold``; classes are the connected components of the links. Texts without words (null,
    empty, punctuation only) are copies of each other. Texts of fewer than ``width`` words are one
    shingle. Repeated rows and ids share what their text gets. Null ids order last, so only a class
    of null ids has a null class_id. Other columns are left out.

    Candidates share the ordered ``minima`` smallest distinct shingles of one of ``bands`` orders, or
    the smallest occurrence-labelled ones if both repeat some. At similarity ``s`` over distinct
    shingles, those matched being in the order of their first occurrences, all but ``(1 - s ** minima)
    ** bands`` of pairs do (about 1 in 100,000 at 0.8), however often lines repeat. In each bucket all
    texts are compared with its most connected one; whatever that leaves in several components is
    searched by an exact prefix filter, so no bucket is compared pair by pair and none is cut.
    """
    rows, placed = _classes(df, id, text, width, threshold, bands, minima)
    return rows.select("id", "c").join(placed.select("c", F.col("id").alias("class_id")), "c").select(F.col("id").alias(id), "class_id")


def keep_first(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 16, minima: int = 3
) -> DataFrame:
    """``df`` with only the first document (smallest id, then a hash) of each class of `near_classes`."""
    _, placed = _classes(df, id, text, width, threshold, bands, minima)
    key = free(df, "k")
    stay = placed.select(F.col("k").alias(key)).distinct()
    keyed = df.withColumn(key, F.xxhash64(F.col(id), F.col(text)))
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).select(df.columns)
