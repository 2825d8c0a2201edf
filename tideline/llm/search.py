"""Ranked lexical search without an index: one guarded Aho-Corasick automaton of all item terms scans every document."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tideline.llm.arrow import release, widen
from tideline.llm.decontam import FOLD, words_of
from tideline.session import settle

#: (document, item) cells and candidates a task holds at a time.
CELLS, CANDIDATES = 1 << 20, 1 << 19
#: Groups that each item's candidates are ranked in before they meet.
GROUPS = 64


def n_terms(folded: bytes) -> int:
    """Number of runs of bytes other than spaces."""
    solid = np.frombuffer(folded, np.uint8) != 0x20
    return int(np.count_nonzero(solid[1:] & ~solid[:-1])) + int(solid[:1].sum())


def automaton_of(terms: Sequence[str]) -> ahocorasick.Automaton | None:
    """Finds each term between two spaces and gives its number; neighbours share a space."""
    if not terms:
        return None
    automaton = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        automaton.add_word(f" {term} ", number)
    automaton.make_automaton()
    return automaton


def frequencies(df: DataFrame, terms: Sequence[str], *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's id, n (its terms with repeats), and of ``terms`` the numbers that occur and how often (term, tf).

    Terms of a text are runs of ASCII digits, letters and all other characters beyond ASCII, of which A-Z
    are lower-cased; a null text has none. ``terms`` are broadcast: bound their size first.
    """
    shared = df.sparkSession.sparkContext.broadcast(list(terms))

    def make():
        automaton = automaton_of(shared.value)

        def work(texts):
            sizes, numbers, counts = [], [], []
            for value in texts:
                folded = (value or b"").translate(FOLD)
                sizes.append(n_terms(folded))
                found: Counter = Counter()
                if automaton and sizes[-1]:
                    found.update(map(itemgetter(1), automaton.iter(f" {folded.decode()} ")))
                numbers.append(list(found))
                counts.append(list(found.values()))
            return sizes, numbers, counts

        return work

    return widen(df.select(F.col(id).alias("id"), F.col(text)), text, "n long, term array<int>, tf array<long>", make, ["id"], as_bytes=True)


class Scorer:
    """Scores of documents for all items of a block, from the documents' term frequencies."""

    def __init__(self, weights: np.ndarray, items: Sequence[Sequence[int]], documents: int, length: int):
        """``weights`` by term, ``items`` their distinct terms, the corpus' documents and terms with repeats."""
        self.weights, self.items, self.documents, self.length = weights, len(items), documents, length
        flat = np.array([t for terms in items for t in terms], np.int64)
        owner = np.repeat(np.arange(len(items)), [len(terms) for terms in items])
        order = np.argsort(flat, kind="stable")
        self.owners = owner[order]
        self.fan = np.bincount(flat, minlength=len(weights)).astype(np.int64)
        self.first = np.cumsum(self.fan) - self.fan

    def scores(self, n: np.ndarray, edge: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """A row for each document, a column for each item; document ``d`` has the terms between ``edge[d]`` and ``edge[d + 1]``."""
        # Python numbers: n times the documents may need more than 64 bits.
        m = np.array([50 + 50 * x * self.documents // self.length for x in n.tolist()], np.int64)
        row = np.repeat(np.arange(len(n)), np.diff(edge))
        gain = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
        cells = np.zeros(len(n) * self.items, np.int64)
        fan = self.fan[term]
        ends = np.cumsum(fan)
        begin = 0
        while begin < len(term):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CELLS, side="right")))
            times = fan[begin:stop]
            each = np.repeat(np.arange(begin, stop), times)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
            cell = row[each] * self.items + self.owners[self.first[term[each]] + nth]
            # Halves of 32 bits: bincount adds in doubles, which are exact for fewer than 2 ** 21 terms.
            low = np.bincount(cell, gain[each] & 0xFFFFFFFF, len(cells)).astype(np.int64)
            cells += low
            if len(gain) and int(gain[begin:stop].max()) >> 32:
                cells += np.bincount(cell, gain[each] >> 32, len(cells)).astype(np.int64) << 32
            begin = stop
        return cells.reshape(len(n), self.items)


class Best:
    """The ``k`` best candidates of each item so far, and the score that a new one has to reach."""

    def __init__(self, items: int, k: int, kind: pa.DataType):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.found: list[pa.Table] = []
        self.kind, self.held = kind, 0

    def add(self, ids: pa.Array, scores: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.floor)
        if len(row):
            columns = [pa.array(item, pa.int32()), ids.take(pa.array(row)), pa.array(scores[row, item], pa.int64())]
            self.found.append(pa.table(columns, names=["item", "id", "score"]))
            self.held += len(row)
        if self.held > CANDIDATES:
            self.trim()

    def trim(self) -> pa.Table:
        table = pa.concat_tables(self.found) if self.found else pa.table({"item": pa.array([], pa.int32()), "id": pa.array([], self.kind), "score": pa.array([], pa.int64())})
        keys = [("item", "ascending"), ("score", "descending"), ("id", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=keys))
        item = table.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        table = table.filter(pa.array(rank < self.k))
        last = np.flatnonzero(rank == self.k - 1)
        self.floor[item[last]] = pc.take(table.column("score"), pa.array(np.flatnonzero(rank[rank < self.k] == self.k - 1))).to_numpy()
        self.found, self.held = [table], 0
        return table


def _best(counted: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """Of each task, the best candidates of each item: item (its number), id, score."""
    shared = counted.sparkSession.sparkContext.broadcast(scorer)
    key = counted.schema["id"]
    out = StructType().add("item", "integer").add("id", key.dataType).add("score", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        scorer = shared.value
        best = Best(scorer.items, k, schema.field("id").type)
        step = max(1, CELLS // max(1, scorer.items))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                lists = part.column(2)
                edge = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
                term, tf = lists.flatten().to_numpy(), part.column(3).flatten().to_numpy()
                best.add(part.column(0), scorer.scores(part.column(1).to_numpy(), edge, term, tf))
        yield from best.trim().cast(schema).to_batches()
        release()

    return counted.select("id", "n", "term", "tf").filter(F.size("term") > 0).mapInArrow(run, out)


def _block(df: DataFrame, items: list, k: int, id: str, text: str, item: StructField) -> DataFrame:
    texts = [list(dict.fromkeys(w.decode() for w in words_of(t))) for _, t in items]
    terms = list(dict.fromkeys(w for words in texts for w in words))
    number = {w: i for i, w in enumerate(terms)}
    counted = settle(frequencies(df, terms, id=id, text=text), "search-terms")
    documents, length = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    weights = np.zeros(len(terms), np.int64)
    for row in counted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        weights[row["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["df"] + 1)))
    found = _best(counted, Scorer(weights, [[number[w] for w in words] for words in texts], documents, length or 0), k)
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    # A hot item's candidates, k for each task, are cut in groups before they meet.
    within = Window.partitionBy("item", F.pmod(F.xxhash64("id"), F.lit(GROUPS))).orderBy(*order)
    cut = found.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= k).drop("place")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    names = df.sparkSession.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], StructType().add("item", "integer").add("name", item.dataType))
    return ranked.join(F.broadcast(names), "item").select(F.col("name").alias(item.name), F.col("rank"), F.col("id").alias(id), F.col("score"))


def search(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    k: int = 50,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """Each item's ``k`` highest-scoring documents with a score above 0: item, rank from 1, id, score.

    A document's score for an item sums ``w * (1e9 * tf div (1000 * tf + 20 * m))`` over the item's distinct
    terms, with ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 50 + 50 * n * N div L``; N counts
    documents with a term, L all their terms, n the document's. Equal scores rank by id (null ids last).

    Null and empty texts and items have no terms: they count nowhere and are never found. Each row of
    either table is a document or item of its own, repeated or not. Texts are scanned whole where they
    lie; only (term, tf) pairs of item terms are written, and ``k`` candidates per item and task are
    shuffled. Other columns are left out, so their names cannot clash. Empty tables give no rows.

    The automaton travels to every task, so items go in blocks of about ``block_bytes`` of text
    (measured; an item longer than that is a block). Each block scans the documents once.
    """
    rows = benchmark.select(F.col(item).alias("name"), F.col(item_text).cast("string").cast("binary").alias("t")).filter(F.length("t") > 0)
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    kind = StructField(item, benchmark.schema[item].dataType)
    if blocks == 1:
        return _block(df, [tuple(r) for r in rows.collect()], k, id, text, kind)
    dealt = settle(rows.withColumn("b", F.pmod(F.xxhash64("name", "t"), F.lit(blocks))), "search-items")
    parts = [_block(df, [tuple(r) for r in dealt.filter(F.col("b") == b).select("name", "t").collect()], k, id, text, kind) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts)
