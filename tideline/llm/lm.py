"""Language-model scores: stupid backoff over n-gram counts of the whole corpus, computed by joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import blocks
from tideline.llm.arrow import slices, values
from tideline.llm.words import SPACED, coded, mix
from tideline.session import settle

#: Log probabilities are whole millionths, so sums do not depend on their order.
MICRO = 1_000_000
ROWS, BYTES = 4096, 8 << 20
#: Bits of a hash by which short runs that may be a whole text are known; 1 MiB for all tasks.
MARKED = 20


def micro_log(x: np.ndarray | float) -> np.ndarray:
    return np.rint(np.log(x) * MICRO).astype(np.int64)


class Slice:
    """Words and bigrams of a run of texts."""

    def __init__(self, texts: list[str | None]):
        self.words, self.index, self.edge = coded(texts)
        size = np.diff(self.edge)
        self.size = size
        self.doc = np.repeat(np.arange(len(size)), size)
        follows = np.ones(len(self.index), bool)
        follows[self.edge[:-1][size > 0]] = False
        #: Places of words that have one before them, and of those that have none.
        self.second = np.flatnonzero(follows)
        self.first = np.flatnonzero(~follows)
        w = self.words[self.index]
        self.pair = mix(w[self.second - 1] * np.uint64(0x9E3779B97F4A7C15) + w[self.second]) if len(w) else w


def _map(source: DataFrame, make: Callable[[], Callable[[Slice, pa.RecordBatch], list]], schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, "text", ROWS, BYTES):
                yield pa.RecordBatch.from_arrays(work(Slice(values(part.column("text"))), part), names=names)

    return source.mapInArrow(run, schema)


def _count(keys: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    value, n = np.unique(keys, return_counts=True)
    return value[n >= least].view(np.int64), n[n >= least]


class Table:
    """Counts by hash, as sorted arrays."""

    def __init__(self, rows: DataFrame | None):
        """``rows`` (h, c) come to the driver as Arrow columns; their number is bounded by the caller."""
        columns = rows.select("h", "c").toArrow() if rows else {"h": np.zeros(0, np.int64), "c": np.zeros(0, np.int64)}
        keys, counts = (np.asarray(columns[name]) for name in ("h", "c"))
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def get(self, keys: np.ndarray, other: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), other, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], other)


def score(
    df: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    order: int = 3,
    backoff: float = 0.4,
    least: int = 1,
    head: int = 1 << 19,
    broadcast_words: int = 4_000_000,
) -> DataFrame:
    """(id, n_words, log_score, score): stupid-backoff score of every row under n-gram counts of all rows, n up to ``order``.

    A word scores c(g) / c(g without its last word) for the longest run g of at most ``order`` words
    of its text that ends there and has a count of at least ``least`` in the whole corpus, times
    ``backoff`` for each order in between; a single word scores c(w) / N. With ``least`` = 2 a run
    seen once, known only from the text being scored, backs off. Words are lower-cased runs of
    letters and digits. ``log_score`` is the sum of natural logarithms in millionths, each rounded;
    ``score`` their mean per word, null for texts without words (null and empty ones too). Repeated
    rows count as often as they stand and get a row each. Other columns are left out.

    Counts of all orders are added up in each slice before their shuffle. What a run adds to the
    score of the run without its first word needs only counts, so it is worked out once for each
    distinct run and joined to one row for each document and run. With ``least`` = 1 every run of a
    text has a count, so nothing backs off and the sum needs fewer counts (`_all_counts`); order 2 has
    a plan of its own too (`_bigrams`). Only the latter heeds ``head`` and ``broadcast_words``.
    """
    if order > 2 and least <= 1:
        return _all_counts(df, id=id, text=text, order=order)
    if order == 2:
        return _bigrams(df, id=id, text=text, backoff=backoff, least=least, head=head, broadcast_words=broadcast_words)
    source = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(id), F.col(text)).alias("k"))
    log_back = int(micro_log(backoff))

    def runs(s: Slice) -> list[tuple[np.ndarray, ...]]:
        """For each order: places, hashes, hashes without the last and without the first word."""
        w = s.words[s.index]
        nth = np.arange(len(w)) - s.edge[:-1][s.doc]
        at, h = np.arange(len(w)), mix(w)
        out = [(at, h, np.zeros(len(w), np.uint64), np.zeros(len(w), np.uint64))]
        for n in range(1, order):
            last = np.zeros(len(w), np.uint64)
            last[out[-1][0]] = out[-1][1]
            at = np.flatnonzero(nth >= n)
            out.append((at, mix(last[at - 1] * np.uint64(0x9E3779B97F4A7C15) + w[at] + np.uint64(n)), last[at - 1], last[at]))
        return out

    def corpus():
        def work(s: Slice, _: pa.RecordBatch):
            parts = [(h, p, q, np.full(len(at), n)) for n, (at, h, p, q) in enumerate(runs(s), 1)]
            h, p, q, o = (np.concatenate(x) for x in zip(*parts))
            h, place, n = np.unique(h, return_index=True, return_counts=True)
            return [*(pa.array(x.view(np.int64)) for x in (h, p[place], q[place])), pa.array(o[place].astype(np.int32)), pa.array(n.astype(np.int64))]

        return work

    def spread():
        def work(s: Slice, part: pa.RecordBatch):
            docs, runs_of = part.column("k").to_numpy().view(np.uint64), runs(s)
            h, doc = np.concatenate([x[1] for x in runs_of]), np.concatenate([s.doc[x[0]] for x in runs_of])
            _, place, n = np.unique(mix(h ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
            # Rows of a document stand together, which compresses best.
            by_doc = np.argsort(doc[place], kind="stable")
            place, n = place[by_doc], n[by_doc]
            return [*(pa.array(x.view(np.int64)) for x in (h[place], docs[doc[place]])), pa.array(n.astype(np.int32))]

        return work

    def sizes():
        def work(s: Slice, part: pa.RecordBatch):
            own = log_back * sum(np.maximum(s.size - n, 0) for n in range(1, order))
            return [part.column("id"), part.column("k"), pa.array(s.size.astype(np.int64)), pa.array(np.asarray(own + 0 * s.size, np.int64))]

        return work

    sums = [F.sum("n").alias("c"), *(F.min(x).alias(x) for x in "pqo")]
    counted = settle(_map(source.select("text"), corpus, "h long, p long, q long, o int, n long").groupBy("h").agg(*sums), "lm-runs")
    log_total = int(micro_log(max(counted.where("o = 1").agg(F.sum("c")).first()[0] or 0, 1)))
    logs = counted.withColumn("l", F.rint(F.ln("c") * MICRO).cast("long"))
    before = logs.select(F.col("h").alias("p"), F.col("l").alias("lp"))
    ratio = logs.join(before, "p", "left").select("h", "q", "o", "c", (F.col("l") - F.coalesce("lp", F.lit(log_total))).alias("v"))
    ratio = settle(ratio.where((F.col("o") == 1) | (F.col("c") >= least)), "lm-ratios")
    shorter = ratio.select(F.col("h").alias("q"), F.col("v").alias("vq"))
    # Counts fall with the length of a run, so what the runs of a word add sums to its longest one that counts.
    gain = F.col("v") - F.when(F.col("o") > 1, F.col("vq") + log_back).otherwise(0)
    gains = ratio.join(shorter, "q", "left").select("h", gain.alias("gain"))
    worth = _map(source, spread, "h long, k long, n int").join(gains, "h").groupBy("k").agg(F.sum(F.col("n") * F.col("gain")).alias("s"))
    kind = dict(source.dtypes)["id"]
    docs = _map(source, sizes, f"id {kind}, k long, n_words long, own long").groupBy("id", "k", "n_words", "own").agg(F.count(F.lit(1)).alias("rows"))
    each = docs.join(worth, "k", "left").withColumn("log_score", F.col("own") + F.coalesce((F.col("s") / F.col("rows")).cast("long"), F.lit(0)))
    each = each.select("id", "n_words", "log_score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(F.col("id").alias(id), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.lit(float(MICRO)) / F.col("n_words")).alias("score"))


def _all_counts(df: DataFrame, *, id: str, text: str, order: int) -> DataFrame:
    """`score` for counts from one on and an ``order`` of three or more.

    The score of a word is log c(its run) - log c(that run without its last word), and what one word
    subtracts is what the word before would add at the next lower order. Summed over a text of at
    least ``order`` words there remain: plus its runs of ``order`` words, minus its runs of one word
    less, the first and the last of these left out, minus log N; of a shorter text, the whole text's
    count and log N.

    Texts are kept as numbered words in slices. A slice sends each distinct run once, whatever its
    number of documents, as sorted hashes in blocks (`blocks.with_counts`), gets the counts back in the same
    order and sums its texts. So a frequent run is one entry a slice. Runs of less than ``order`` - 1 words count only
    as whole texts; they are sent where the first ``MARKED`` bits of their hash are those of such a text.
    """
    spark = df.sparkSession
    kept = blocks.keep_words(df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")), SPACED, "lm-words")
    total = blocks.count_words(kept)
    log_total = int(micro_log(max(total, 1)))

    def runs(words: blocks.Words, most: int = order) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length up to ``most``: places of last words, and hashes."""
        w = words.of[words.index]
        nth = np.arange(len(w)) - words.edge[:-1][words.doc]
        out = [(np.arange(len(w)), mix(w))]
        for n in range(1, most):
            last = np.zeros(len(w), np.uint64)
            last[out[-1][0]] = out[-1][1]
            at = np.flatnonzero(nth >= n)
            out.append((at, mix(last[at - 1] * np.uint64(0x9E3779B97F4A7C15) + w[at] + np.uint64(n))))
        return out

    def marks(words: blocks.Words) -> list:
        size = words.size[words.doc]
        whole = [h[size[at] == n] for n, (at, h) in enumerate(runs(words, order - 2), 1)]
        return [pa.array(np.unique(np.concatenate(whole) >> np.uint64(64 - MARKED)).astype(np.int64))]

    marked = np.zeros(1 << MARKED, bool)
    marked[np.asarray(blocks.each(kept, marks, "mark long").distinct().toArrow()["mark"], np.int64)] = True
    shared = spark.sparkContext.broadcast(marked)

    def sent(words: blocks.Words) -> list[tuple[np.ndarray, np.ndarray]]:
        found = runs(words)
        own = [shared.value[h >> np.uint64(64 - MARKED)] for _, h in found[: order - 2]]
        return [(at[mine], h[mine]) for (at, h), mine in zip(found, own)] + found[order - 2 :]

    def keys(words: blocks.Words) -> np.ndarray:
        found = sent(words)
        words.sent = [at.astype(np.int32) if len(words.index) < 1 << 31 else at for at, _ in found]  # for `summed`
        return np.concatenate([h for _, h in found])

    def summed(words: blocks.Words, counts: np.ndarray) -> list:
        start, sums = 0, np.zeros(len(words.size), np.int64)
        for n, at in enumerate(words.sent, 1):
            doc = words.doc[at]
            size, place = words.size[doc], at - words.edge[doc]
            # A text of fewer than ``order`` words counts as a whole.
            factor = ((size == n) | (n == order)).astype(np.int64)
            if n == order - 1:
                factor -= (place >= n) & (place < size - 1)
            del size, place
            worth = factor * micro_log(counts[start : start + len(at)].astype(float))
            sums += np.bincount(doc, weights=worth, minlength=len(sums)).astype(np.int64)
            start += len(at)
        return [words.row["id"], pa.array(words.size), pa.array(sums - np.where(words.size > 0, log_total, 0))]

    kind = df.select(F.col(id).alias("id")).schema
    each = blocks.with_counts(kept, keys, total * order, summed, kind.add("n_words", "long").add("log_score", "long"))
    return each.select(F.col("id").alias(id), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.lit(float(MICRO)) / F.col("n_words")).alias("score"))


def _bigrams(
    df: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    backoff: float = 0.4,
    least: int = 2,
    head: int = 1 << 19,
    broadcast_words: int = 4_000_000,
) -> DataFrame:
    """(id, n_words, log_score, score): stupid-backoff bigram score of every row under counts of all rows.

    A word w after v scores c(v w) / c(v) if the bigram's count in the whole corpus is at least
    ``least`` (a bigram seen once is known only from the text being scored), else ``backoff`` *
    c(w) / N; a text's first word scores c(w) / N. Words are lower-cased runs of letters and digits.
    ``log_score`` is the sum of natural logarithms in millionths, each rounded; ``score`` their mean
    per word, null for texts without words (null and empty ones too). Repeated rows count as often
    as they stand and get a row each. Other columns are left out.

    Word counts are added up in each slice before their shuffle. Bigrams are exploded to rows (hash,
    document, times) and dealt by hash once: their count is a window sum over that hash, and the rows
    are summed per document, again in each task first. The ``head`` most frequent bigrams, which
    could fill a task, are counted apart, added up before the shuffle, and looked up where the text
    is; so are words, of which at most ``broadcast_words`` with a count of 2 or more are broadcast
    (16 bytes each). If there are more, bigram rows carry their words and join the word counts. Both
    limits change the plan and not the result.
    """
    spark = df.sparkSession
    source = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(id), F.col(text)).alias("k"))
    texts = source.select("text")

    def words_and_candidates():
        def work(s: Slice, _: pa.RecordBatch):
            n = np.bincount(s.index, minlength=len(s.words))
            h, m = _count(s.pair, 3)
            kind = np.concatenate((np.zeros(len(n), np.int8), np.ones(len(h), np.int8)))
            return [pa.array(kind), pa.array(np.concatenate((s.words.view(np.int64), h))), pa.array(np.concatenate((n, m)).astype(np.int64))]

        return work

    counted = settle(_map(texts, words_and_candidates, "kind byte, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("c")), "lm-words")
    words = counted.where("kind = 0 AND c > 0").select("h", "c")
    total = words.agg(F.sum("c")).first()[0] or 0
    often = words.where("c > 1")
    local = often.count() <= broadcast_words

    # Candidates of the head: bigrams frequent in some slice; then their exact counts.
    top = counted.where("kind = 1").orderBy(F.col("c").desc(), "h").limit(head).select("h", "c")
    chosen = spark.sparkContext.broadcast(Table(top))

    def head_counts():
        def work(s: Slice, _: pa.RecordBatch):
            h, n = _count(s.pair)
            mine = chosen.value.get(h, 0) > 0
            return [pa.array(h[mine]), pa.array(n[mine].astype(np.int64))]

        return work

    exact = _map(texts, head_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))
    known = spark.sparkContext.broadcast((Table(exact), Table(often if local else None)))
    log_total, log_back = int(micro_log(max(total, 1))), int(micro_log(backoff))

    def explode():
        def work(s: Slice, part: pa.RecordBatch):
            heads, vocab = known.value
            docs = len(s.size)
            log_word = micro_log(vocab.get(s.words.view(np.int64), 1).astype(float))[s.index] if local else np.zeros(len(s.index), np.int64)
            before, after = log_word[s.second - 1], log_word[s.second]
            c = heads.get(s.pair.view(np.int64), 0)
            rest = c == 0
            own = np.zeros(docs, np.int64)
            if local:
                unseen = log_back + after - log_total
                # Bigrams of the rest start as unseen; their rows hold what changes if they are not.
                now = np.where(c >= least, micro_log(np.maximum(c, 1).astype(float)) - before, unseen)
                own += np.bincount(s.doc[s.second], weights=now, minlength=docs).astype(np.int64)
                own += np.bincount(s.doc[s.first], weights=log_word[s.first] - log_total, minlength=docs).astype(np.int64)
            # One row for each document and bigram of the rest; two passes keep equal pairs together.
            at = s.second[rest]
            key = mix(s.pair[rest] ^ mix(s.doc[at].astype(np.uint64) + np.uint64(1)))
            _, place, n = np.unique(key, return_index=True, return_counts=True)
            order = np.argsort(s.doc[at[place]], kind="stable")
            place, n = place[order], n[order]
            doc = np.concatenate((np.arange(docs), s.doc[at[place]]))
            ids, keys = part.column("id").take(pa.array(doc)), part.column("k").take(pa.array(doc))
            zero = np.zeros(docs, np.int64)
            h = np.concatenate((part.column("k").to_numpy(), s.pair[rest][place].view(np.int64)))
            gain = -before[rest][place] - (log_back + after[rest][place] - log_total)
            none = np.zeros(len(place), np.int64)
            counts = (np.concatenate((zero, gain)), np.concatenate((zero, n)), np.concatenate((s.size, none)))
            small = [pa.array(v.astype(np.int32)) for v in counts]
            return [pa.array(h), *small, ids, keys, pa.array(np.concatenate((own, none)))]

        return work

    def explode_wide():
        """The same for words too many to broadcast: every bigram with its words, a head one with its count."""

        def work(s: Slice, part: pa.RecordBatch):
            heads, docs = known.value[0], len(s.size)
            key = mix(s.pair ^ mix(s.doc[s.second].astype(np.uint64) + np.uint64(1)))
            _, place, n = np.unique(key, return_index=True, return_counts=True)
            at, w = s.second[place], s.words.view(np.int64)[s.index]
            c = heads.get(s.pair[place].view(np.int64), 0)
            doc = np.concatenate((np.arange(docs), s.doc[s.first], s.doc[at]))
            ids, keys = part.column("id").take(pa.array(doc)), part.column("k").take(pa.array(doc))
            skip = docs + len(s.first)
            # Rows that need no count of their own are dealt by document.
            h = np.concatenate((part.column("k").to_numpy()[doc[:skip]], np.where(c > 0, part.column("k").to_numpy()[doc[skip:]], s.pair[place].view(np.int64))))
            times = np.concatenate((np.zeros(docs), np.ones(len(s.first)), n)).astype(np.int32)
            size = np.concatenate((s.size, np.zeros(len(doc) - docs))).astype(np.int32)
            none = np.zeros(docs, np.int64)
            w1, w2 = np.concatenate((none, w[s.first], w[at - 1])), np.concatenate((none, w[s.first], w[at]))
            count = np.concatenate((none, np.full(len(s.first), -1), c))
            return [pa.array(h), ids, keys, *map(pa.array, (times, size, w1, w2, count))]

        return work

    kind = dict(source.dtypes)["id"]
    if local:
        # The row of a document itself has n = 0, its number of words and what was scored on the spot.
        # What differs from row to row stands together, which is what compresses best.
        rows = _map(source, explode, f"h long, gain int, n int, words int, id {kind}, k long, own long")
        rows = rows.withColumns({"known": F.lit(0).cast("long"), "base": F.lit(0)})
    else:
        rows = _map(source, explode_wide, f"h long, id {kind}, k long, n int, words int, w1 long, w2 long, known long")
        rows = rows.withColumn("own", F.lit(0).cast("long"))
        for w in ("w1", "w2"):
            rows = rows.join(often.select(F.col("h").alias(w), F.col("c").alias("c_" + w)), w, "left")
        of = {w: F.rint(F.ln(F.coalesce("c_" + w, F.lit(1))) * MICRO).cast("long") for w in ("w1", "w2")}
        first = F.col("known") == -1
        rows = rows.withColumn("base", of["w2"] - log_total + F.when(first, 0).otherwise(log_back)).withColumn("gain", -of["w1"] - F.col("base"))
    in_window = F.sum("n").over(Window.partitionBy("h"))
    c = F.when(F.col("known") == 0, in_window).when(F.col("known") > 0, F.col("known")).otherwise(0)
    log_c = F.rint(F.ln(F.greatest("c", F.lit(1))) * MICRO).cast("long")
    gained = F.when((F.col("n") > 0) & (F.col("c") >= least), log_c + F.col("gain")).otherwise(0)
    worth = F.col("own") + F.col("n") * (F.col("base") + gained)
    summed = rows.withColumn("c", c).groupBy("id", "k").agg(F.sum("words").alias("words"), F.sum(worth).alias("s"), F.sum((F.col("n") == 0).cast("long")).alias("rows"))
    # Rows equal in id and text were summed together.
    each = summed.select("id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))), (F.col("words") / F.col("rows")).cast("long").alias("n_words"), (F.col("s") / F.col("rows")).cast("long").alias("log_score"))
    return each.select(F.col("id").alias(id), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.lit(float(MICRO)) / F.col("n_words")).alias("score"))
