"""Benchmark decontamination: windows of benchmark words found by one Aho-Corasick scan of each text."""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import free, widen
from tideline.session import settle

#: A-Z lower-cased; every other ASCII character that is no digit or letter becomes a space. Byte offsets stay.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
HITS = "array<struct<first: long, last: long, start: long, end: long>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Windows:
    """Automaton over word numbers. Words of no window share number 0, which leads back to the root."""

    def __init__(self, items: Sequence[tuple[str | None, bytes | None]], width: int):
        self.ids: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        owners: dict[tuple[int, ...], set[int]] = {}
        for i, (_, text) in enumerate(items):
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            for at in range(max(1, len(words) - width + 1) if words else 0):
                owners.setdefault(tuple(words[at : at + width]), set()).add(i)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, own in owners.items():
            self.automaton.add_word(window, (len(window), own))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in an occurrence of a window, and the items those windows belong to."""
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        items: set[int] = set()
        if words and not self.empty:
            number = self.ids.get
            for end, (length, own) in self.automaton.iter(tuple([number(w, 0) for w in words])):
                edge[end + 1 - length] += 1
                edge[end + 1] -= 1
                items |= own
        return np.cumsum(edge[:-1]) > 0, items


def runs_of(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words: word numbers [first, last) and code point offsets [start, end) of the original text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.frombuffer(text.translate(FOLD), dtype=np.uint8) != 0x20
    turn = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    run = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).tolist()
    return [
        {"first": a, "last": b, "start": int(chars[turn[2 * a]]), "end": int(chars[turn[2 * b - 1]])}
        for a, b in zip(run[::2], run[1::2])
    ]


def _scan(df: DataFrame, items: list[tuple[str | None, bytes | None]], width: int, text: str, carry) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(items)

    def make():
        windows = Windows(shared.value, width)

        def work(texts):
            n_words, found, hits = [], [], []
            for value in texts:
                words = words_of(value)
                hit, own = windows.find(words)
                n_words.append(len(words))
                names = {windows.names[i] for i in own}
                found.append(sorted(names - {None}) + [None] * (None in names))
                hits.append(runs_of(value, hit) if own else [])
            return n_words, found, hits

        return work

    return widen(df, text, f"n_words long, __items array<string>, __hits {HITS}", make, carry, as_bytes=True)


def _unite(hits: Column) -> Column:
    """Overlapping or touching runs as one."""

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(
            last["first"].alias("first"),
            F.greatest(last["last"], run["last"]).alias("last"),
            last["start"].alias("start"),
            F.greatest(last["end"], run["end"]).alias("end"),
        )
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))
        return F.when((F.size(done) > 0) & (last["last"] >= run["first"]), joined).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(hits), F.array().cast(HITS), add)


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 13,
    parts: int = 20,
    block_bytes: int = 1 << 20,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Add n_words, n_hit, n_items, items, spans and contaminated to every row of ``df``.

    A window is ``width`` consecutive words of an item; an item of fewer, but not none, is one window.
    A word inside any occurrence of a window is hit; ``items`` are the distinct non-null ids (as
    strings, sorted) with an occurring window, ``spans`` the runs of hit words as code point offsets
    of the original text. ``contaminated``: some word is hit, and at least one word in
    ``parts`` is. Null and empty texts have no words and are clean. Repeated rows are judged alike. Items
    without an id hit words and count as one in ``n_items``, but are not listed. Columns of ``df`` under the added names are replaced.

    Texts are scanned where they lie, without a shuffle. The items travel in blocks of about
    ``block_bytes`` (measured); a benchmark of several blocks is scanned block by block, and the
    spans of all blocks are united, so its size changes the plan and not the result.
    """
    spark = df.sparkSession
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).cast("string").cast("binary").alias("t"))
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    added = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    names = [c for c in (carry if carry is not None else df.columns) if c not in added]
    hits = free(df, "hits")
    if blocks == 1:
        out = _scan(df, [tuple(r) for r in rows.collect()], width, text, names)
        out = out.withColumnsRenamed({"__items": "items", "__hits": hits})
    else:
        of = settle(rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks))), "benchmark")
        out = df.select(*dict.fromkeys([*names, text])).withColumns({"items": F.array().cast("array<string>"), hits: F.array().cast(HITS)})
        for b in range(blocks):
            part = [tuple(r) for r in of.filter(F.col("b") == b).select("i", "t").collect()]
            both = {"items": F.array_sort(F.array_union("items", "__items")), hits: _unite(F.concat(hits, "__hits"))}
            out = settle(_scan(out, part, width, text, None).withColumns(both).drop("__items", "__hits"), "decontam")
    n_hit = F.aggregate(hits, F.lit(0).cast("long"), lambda n, run: n + run["last"] - run["first"])
    out = out.select(
        *names,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.array_compact("items").alias("items"),
        F.transform(hits, lambda run: F.struct(run["start"].alias("start"), run["end"].alias("end"))).alias("spans"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * parts >= F.col("n_words")))
