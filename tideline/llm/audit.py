"""Filter interaction audit: what each filter removes in each order, from one byte pass over every text."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import combinations, permutations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import widen
from tideline.llm.words import mix
from tideline.session import settle

#: States of the transducer.
BETWEEN, INSIDE = 0, 1
#: What it emits for a byte, as bits.
BEGINS, ENDS, CAPITAL, CONTINUES, SYMBOL = 1, 2, 4, 8, 16
SPACES, SYMBOLS = b"\t\n\v\f\r ", b"#$%&*|"
#: Bytes the transducer takes at a time.
WINDOW = 1 << 20
#: Words of at most so many bytes are hashed and compared as arrays of 8-byte lanes, longer ones one by one.
LANED = 64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted bits by (state, byte)."""
    follow, emit = np.zeros((2, 256), np.uint8), np.zeros((2, 256), np.uint8)
    for byte in range(256):
        space = byte in SPACES
        bits = CAPITAL if 0x41 <= byte <= 0x5A else CONTINUES if 0x80 <= byte <= 0xBF else SYMBOL if byte in SYMBOLS else 0
        follow[:, byte] = BETWEEN if space else INSIDE
        emit[BETWEEN, byte] = bits | (0 if space else BEGINS)
        emit[INSIDE, byte] = bits | (ENDS if space else 0)
    return follow, emit


FOLLOW, EMIT = _tables()


def transduce(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Emitted bits for each byte and the state after the last.

    Every byte leads to the same state from both, so the state before a byte is a look-up of the byte
    before it and all transitions of a window are taken at once.
    """
    after = FOLLOW[BETWEEN][data]
    before = np.empty_like(after)
    before[:1], before[1:] = state, after[:-1]
    return EMIT.ravel()[(before.astype(np.uint16) << 8) | data], int(after[-1]) if len(after) else state


class SpanTable:
    """A hash table of (document, word) over spans of one buffer; equal hashes are compared byte by byte.

    Open addressing with linear probing, all pending words one probe at a time. ``insert`` returns
    which words were new. It holds the spans of the distinct words only.
    """

    def __init__(self, buffer: bytes):
        self.data = buffer + bytes(8)
        self.lanes = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        self.mask = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
        self.start = self.length = self.doc = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        self.slots = np.full(1 << 12, -1, np.int64)

    def _lane(self, start: np.ndarray, left: np.ndarray) -> np.ndarray:
        return self.lanes[start] & self.mask[np.minimum(left, 8)]

    def _word(self, start: int, length: int) -> bytes:
        return self.data[start : start + length]

    def _hashes(self, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        h = mix((doc * 64 + length % 64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        short = np.flatnonzero(length <= LANED)
        for at in range(0, LANED, 8):
            short = short[length[short] > at]
            if not len(short):
                break
            h[short] = mix(h[short] ^ self._lane(start[short] + at, length[short] - at))
        for i in np.flatnonzero(length > LANED).tolist():
            h[i] ^= np.uint64(xxhash.xxh64_intdigest(self._word(int(start[i]), int(length[i]))))
        return h

    def _equal(self, a: tuple, b: tuple) -> np.ndarray:
        """Whether spans (start, length, doc) ``a`` and ``b`` are the same word of the same document."""
        same = (a[1] == b[1]) & (a[2] == b[2])
        for at in range(0, LANED, 8):
            i = np.flatnonzero(same & (a[1] > at) & (a[1] <= LANED))
            if not len(i):
                break
            left = a[1][i] - at
            same[i] = self._lane(a[0][i] + at, left) == self._lane(b[0][i] + at, left)
        for i in np.flatnonzero(same & (a[1] > LANED)).tolist():
            same[i] = self._word(int(a[0][i]), int(a[1][i])) == self._word(int(b[0][i]), int(b[1][i]))
        return same

    def _place(self, hashes: np.ndarray, first: int, compare) -> tuple[np.ndarray, np.ndarray]:
        """Put spans ``first``, ``first`` + 1, ... into slots; which of them got one, and where each one ended."""
        last = np.uint64(len(self.slots) - 1)
        slot = (hashes & last).astype(np.int64)
        won = np.zeros(len(hashes), bool)
        pending = np.arange(len(hashes))
        while len(pending):
            at = slot[pending]
            vacant = self.slots[at] < 0
            self.slots[at[vacant]] = first + pending[vacant]
            held = self.slots[at]
            mine = held == first + pending
            won[pending[mine]] = True
            rest = np.flatnonzero(~mine)
            found = compare(held[rest], pending[rest]) if compare else np.zeros(len(rest), bool)
            pending = pending[rest[~found]]
            slot[pending] = (slot[pending] + 1) & int(last)
        return won, slot

    def insert(self, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        size, used = len(self.slots), len(self.start)
        while size < 2 * (used + len(start)):
            size *= 2
        if size > len(self.slots):
            self.slots = np.full(size, -1, np.int64)
            self._place(self.hash, 0, None)
        hashes = self._hashes(start, length, doc)
        every = [np.concatenate(pair) for pair in ((self.start, start), (self.length, length), (self.doc, doc))]
        spans = lambda i: tuple(column[i] for column in every)
        won, slot = self._place(hashes, used, lambda held, new: self._equal(spans(held), spans(used + new)))
        new = np.flatnonzero(won)
        self.slots[slot[new]] = used + np.arange(len(new))
        self.start, self.length, self.doc = (np.concatenate((column[:used], column[used + new])) for column in every)
        self.hash = np.concatenate((self.hash, hashes[new]))
        return won


def count(texts: Sequence[bytes | None]) -> list[np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text, in one pass over all of them.

    A space stands behind each text, which closes its last word.
    """
    buffer = b" ".join([*(t or b"" for t in texts), b""])
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    edge = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.frombuffer(buffer, np.uint8)
    table = SpanTable(buffer)
    words, distinct, capitals, continued, symbols = (np.zeros(len(texts), np.int64) for _ in range(5))
    state, opened = BETWEEN, np.zeros(0, np.int64)
    for at in range(0, len(data), WINDOW):
        emitted, state = transduce(data[at : at + WINDOW], state)

        def places(bit: int) -> np.ndarray:
            return at + np.flatnonzero(emitted & bit)

        def documents(place: np.ndarray) -> np.ndarray:
            return np.searchsorted(edge, place, side="right") - 1

        for bit, total in ((CAPITAL, capitals), (CONTINUES, continued), (SYMBOL, symbols)):
            total += np.bincount(documents(places(bit)), minlength=len(texts))
        begin, end = np.concatenate((opened, places(BEGINS))), places(ENDS)
        opened = begin[len(end) :]
        begin = begin[: len(end)]
        doc = documents(begin)
        words += np.bincount(doc, minlength=len(texts))
        distinct += np.bincount(doc[table.insert(begin, end - begin, doc)], minlength=len(texts))
    return [words, distinct, capitals, sizes - continued, symbols]


def measure(df: DataFrame, *, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Add n_words, n_distinct, n_capitals, n_points, n_symbols and digest (SHA-256 of the UTF-8 text).

    Words are what stands between ASCII white space, case-sensitive; capitals are A-Z, symbols
    ``#$%&*|``. A null text is an empty one, which has none of them. Texts are measured where they lie
    and whole; a very long one is passed in windows, with memory for its distinct words. Repeated rows
    are measured alike. Columns of ``df`` under the added names are replaced.
    """

    def make():
        def work(texts):
            return [*count(texts), [hashlib.sha256(t or b"").digest() for t in texts]]

        return work

    added = "n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long, digest binary"
    return widen(df, text, added, make, carry, as_bytes=True)


#: The five filters as bits; a row that fails one has its bit set. E, repeats, is known after the shuffle only.
NAMES = "ABCDE"
REPEAT = 16


def failing() -> Column:
    """Bits of A to D from the columns of `measure`."""
    tests = (
        F.col("n_words") < 200,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * F.col("n_capitals") > 3 * F.col("n_points"),
        F.col("n_symbols") > 0,
    )
    bits = F.lit(0)
    for i, test in enumerate(tests):
        bits = bits + F.when(test, F.lit(1 << i)).otherwise(F.lit(0))
    return bits


def patterns(df: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """How many rows of each part fail which filters: part, bits, good, toxic, n.

    Rows are added up by (text digest, part, label) before digests meet, so a text that a third of
    all rows share is a few rows by then. Of equal texts those with the smallest id pass E (repeated
    rows of one id all do); null ids are larger than none and smaller than none, so they pass too.
    """
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    seen = settle(measure(rows, carry=["id", "part"]).select("id", "part", "digest", failing().alias("bits")), "audit-rows")
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = seen.join(settle(marks, "audit-labels"), "id", "left")
    key = ["digest", "part", "bits", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    single = marked.groupBy("id", *key).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    texts = single.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("nameless"),
        F.min(F.when(known, F.struct("id", "n"))).alias("least"),
    )
    # Rows of a digest are now at most parts times label values.
    across = texts.groupBy("digest").agg(F.min("least.id").alias("first"))
    texts = texts.join(across, "digest")
    stay = F.col("nameless") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = F.array(F.struct("bits", stay.alias("n")), F.struct((F.col("bits") + REPEAT).alias("bits"), (F.col("n") - stay).alias("n")))
    cells = texts.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*")
    return cells.filter("n > 0").groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def interactions(cells: DataFrame) -> DataFrame:
    """The audit of all orders from the counts of `patterns`.

    What a filter does at a step depends on the set before it alone, so each count goes to 80 pairs of
    (set, filter) and these to the 600 steps of the 120 orders, both fixed in number.
    """
    bit = {name: 1 << i for i, name in enumerate(NAMES)}
    pairs = [
        (sum(bit[x] for x in before), bit[name])
        for name in NAMES
        for k in range(len(NAMES))
        for before in combinations([x for x in NAMES if x != name], k)
    ]
    pair = F.explode(F.array([F.struct(F.lit(b).alias("before"), F.lit(f).alias("own")) for b, f in pairs]))
    each = cells.select("*", pair.alias("p")).select("part", "bits", "good", "toxic", "n", "p.before", "p.own")
    bits, before, own = F.col("bits"), F.col("before"), F.col("own")
    here = (bits.bitwiseAND(own) != 0) & (bits.bitwiseAND(before) == 0)

    def total(condition: Column, value: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    fails = bits.bitwiseAND(own) != 0
    sums = each.groupBy("part", "before", "own").agg(
        total(bits.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(fails & (bits.bitwiseAND(before) != 0)).alias("redundant"),
        total(bits == own).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"),
        total(here & F.col("toxic")).alias("toxic_lost"),
        # Of the filters that a row fails, each comes first in an equal share of the 120 orders.
        total(fails, F.col("n") * (F.lit(120) / F.greatest(F.bit_count("bits"), F.lit(1))).cast("long")).alias("shapley"),
    )
    steps = [
        ("".join(order), step + 1, sum(bit[x] for x in order[:step]), bit[order[step]])
        for order in permutations(NAMES)
        for step in range(len(NAMES))
    ]
    orders = cells.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, own int")
    return sums.join(F.broadcast(orders), ["before", "own"]).drop("before", "own")


def audit(df: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """What each of five filters removes at each step of each of their 120 orders, by part.

    Filters (a row fails if): A under 200 words, B ``100 * distinct words < 50 * words``, C ``100 * capitals
    > 3 * code points``, D any of ``#$%&*|``, E the text is that of a smaller id anywhere in the table.
    Returns part (null: empty text), filter_order, step, and as counts of rows kept after the step,
    removed by it, redundant (fail it, removed before), unique_fails (fail it alone), good_lost and
    toxic_lost (removed, labelled 1), and shapley (removed by the step's filter over all orders).

    Null texts are empty ones; a null id fails no E and has no label; an id that has several labels
    counts as good or toxic if one says so. Repeated rows of one id count each. An empty table gives no
    rows; other columns are left out.
    """
    return interactions(patterns(df, labels, id=id, text=text, part=part))
