"""Order-preserving packing of tokenised documents into fixed windows."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tideline.llm.arrow import release, slices, values

#: Latin words with punctuation behind: both parts are pre-tokens of their own for tokenizers that cut at letters.
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)$"
SENTENCE_END = "[.!?…。！？]$"
#: Bytes of distinct words that a task remembers, and about what a word takes besides its letters; it starts anew beyond them.
REMEMBERED, ENTRY = 48 << 20, 160
#: Text encoded at a time: more of it repeats words more often.
ROWS, BYTES = 2048, 4 << 20


#: Words by which a tokenizer shows that it spells bytes as characters and cuts nothing inside a word.
PROBES = ["the", "extraordinarily", "été", "größe", "ÿ", "--", "zzqx"]
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level tokenizers write a byte as its Latin-1 character, those that don't show as the characters from 256 on, in order.
SPELLING = {b: chr(b) for b in _SHOWN} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def spelled(word: str) -> str:
    return word.encode().decode("latin-1").translate(SPELLING)


class WordEncoder:
    """Encodes texts chunk by chunk, so that a task tokenises each distinct word about once.

    A chunk (what stands between white space) is one or two words: letters and the punctuation behind
    them, or the whole chunk if it is anything else. Right for tokenizers whose pre-tokens never cross
    white space or go from letters to punctuation, and for which case does not matter
    (``word_bpe_49k``). Chunks are told apart, split and lower-cased as Arrow columns; the tokenizer
    itself encodes every distinct word. The ids of all remembered words lie in one pool, in which a
    word is a slot.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Whether words can skip the tokenizer's normalisation, which does nothing to lower-case letters.
        self.direct = True
        self.direct = all(np.array_equal(a, b) for a, b in zip(self._directly(PROBES), self._one_by_one(PROBES)))
        self._forget()

    def _forget(self) -> None:
        self.word = {"": 0}
        self.pool = np.zeros(0, np.uint32)
        self.begin = self.length = np.zeros(1, np.int64)
        self.held = 0

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(i) for i in ids], np.int64)

    def _directly(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of words that are one pre-token each, from the tokenizer's model alone."""
        if not self.direct:
            return self._one_by_one(words)
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(w if w.isascii() else spelled(w))] for w in words]
        return np.array([i for word in ids for i in word], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn(self, words: list[str], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        if not words:
            return
        ids, length = encode(words)
        self.word.update(zip(words, range(len(self.word), len(self.word) + len(words))))
        self.begin = np.concatenate((self.begin, len(self.pool) + np.cumsum(length) - length))
        self.length = np.concatenate((self.length, length))
        self.pool = np.concatenate((self.pool, ids))
        self.held += ENTRY * len(words) + sum(map(len, words)) + ids.nbytes

    def _slots(self, chunks: pa.Array) -> np.ndarray:
        """The slots of the two words of each distinct chunk."""
        split = pc.extract_regex(chunks, PLAIN)
        plain = pc.is_valid(split).to_numpy(zero_copy_only=False)
        letters = pc.coalesce(pc.utf8_lower(pc.struct_field(split, "letters")), chunks)
        marks = pc.coalesce(pc.struct_field(split, "marks"), "")
        coded = pa.concat_arrays([letters, marks]).dictionary_encode()
        words, index = values(coded.dictionary), coded.indices.to_numpy()
        if self.held > REMEMBERED:
            self._forget()
        whole = np.zeros(len(words), bool)  # chunks that are anything else
        whole[index[: len(chunks)][~plain]] = True
        known = self.word
        new = [(w, o) for w, o in zip(words, whole.tolist()) if w not in known]
        self._learn([w for w, o in new if not o], self._directly)
        self._learn([w for w, o in new if o], self._one_by_one)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))[index].reshape(2, -1).T

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text's number of ids, and after which ids (and of which text) a sentence ends."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False)
        word = self._slots(coded.dictionary)[number].ravel()
        size = self.length[word]
        end = np.cumsum(size)
        at = np.repeat(self.begin[word] - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)
        end = end[1::2]  # after each chunk
        edge = np.concatenate(([0], np.cumsum(counts)))
        total = np.concatenate(([0], end))[edge]
        stop = pc.match_substring_regex(coded.dictionary, SENTENCE_END).to_numpy(zero_copy_only=False)
        sentence = np.flatnonzero(stop[number])
        return self.pool[at], np.diff(total), end[sentence], np.searchsorted(edge, sentence, side="right") - 1


def cut(stops: np.ndarray, cost: np.ndarray, window: int) -> tuple[list[float], list[int]]:
    """For each stop, the least cost of windows from the first stop to it, and the stop before it on that way.

    A window between two stops pays its padding (``window`` less its length) and the cost of the
    stop it ends at. Neighbouring stops are at most ``window`` apart. One pass with a monotone
    queue: the padding is linear in both ends, so a window minimum of (cost so far + place) decides.
    """
    place, price = stops.tolist(), cost.tolist()
    best, back = [0.0] * len(place), [0] * len(place)
    queue: deque[tuple[float, int]] = deque([(place[0], 0)])
    for i in range(1, len(place)):
        here = place[i]
        low = here - window
        while place[queue[0][1]] < low:
            queue.popleft()
        value, back[i] = queue[0]
        value += window + price[i]
        best[i] = value - here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    return best, back


def way(back: list[int], i: int) -> list[int]:
    """The stops where windows end, up to stop ``i``."""
    out = []
    while i:
        out.append(i)
        i = back[i]
    return out[::-1]


def tail(length: int, window: int, hard: float) -> tuple[float, list[int]]:
    """Cost and lengths of a stream's last tokens: padded, or split at powers of two, which need no padding."""
    if length & (length - 1) == 0:
        return 0.0, [length] if length else []
    part = 1 << (length.bit_length() - 1)
    price, rest = tail(length - part, window, hard)
    return min((float(window - length), [length]), (hard + price, [part, *rest]))


class Packer:
    """Windows over the documents of one task, in their order; holds about ``block`` tokens and the longest document."""

    def __init__(self, window: int, sentence: float, hard: float, block: int):
        self.window, self.sentence, self.hard, self.block = window, sentence, hard, max(block, 16 * window)
        self.ids: list[np.ndarray] = []  # tokens not yet packed
        self.docs: list[tuple[object, int, int, int]] = []  # id, first token in the buffer, start in the document, document's tokens
        self.stops: list[np.ndarray] = []
        self.ends: list[int] = []
        self.size = self.sequence = 0

    def add(self, doc: object, ids: np.ndarray, sentences: np.ndarray) -> None:
        self.docs.append((doc, self.size, 0, len(ids)))
        self.stops.append(sentences + self.size)
        self.ids.append(ids)
        self.size += len(ids)
        self.ends.append(self.size)

    def full(self) -> bool:
        return self.size >= self.block

    def flush(self, last: bool) -> Iterator[tuple]:
        """Pieces (document, start, ids, document's tokens, sequence, offset); keeps the last windows unless it is the end."""
        if not self.size:
            return
        ids = np.concatenate(self.ids)
        ends = np.array(self.ends, dtype=np.int64)
        soft = np.setdiff1d(np.concatenate([*self.stops, np.zeros(0, np.int64)]), ends)
        soft = soft[(soft > 0) & (soft < self.size)]
        place = np.concatenate(([0], ends, soft))
        price = np.concatenate(([0.0], np.zeros(len(ends)), np.full(len(soft), float(self.sentence))))
        order = np.argsort(place, kind="stable")
        place, price = place[order], price[order]
        # Long stretches without a boundary get stops where a cut is dear.
        step = max(1, self.window // 128)
        gaps = np.flatnonzero(np.diff(place) > step)
        inner = [np.arange(place[g] + step, place[g + 1], step) for g in gaps]
        if inner:
            more = np.concatenate(inner)
            place, price = np.concatenate((place, more)), np.concatenate((price, np.full(len(more), float(self.hard))))
            order = np.argsort(place, kind="stable")
            place, price = place[order], price[order]
        best, back = cut(place, price, self.window)
        near = range(int(np.searchsorted(place, self.size - self.window, side="right")), len(place))
        if last:
            ends_at = [best[i] + tail(self.size - int(place[i]), self.window, self.hard)[0] for i in near]
            stop = near[int(np.argmin(ends_at))]
            rest = tail(self.size - int(place[stop]), self.window, self.hard)[1]
            cuts = place[way(back, stop)].tolist() + (place[stop] + np.cumsum(rest, dtype=np.int64)).tolist()
        else:  # more will come: where the windows of this block end is left open
            cuts = place[way(back, near[int(np.argmin([best[i] for i in near]))])].tolist()
            cuts = cuts[: max(1, len(cuts) - 4)]
        begin = 0
        starts = [d[1] for d in self.docs] + [self.size]
        k = 0
        for end in cuts:
            offset = 0
            while begin < end:
                while starts[k + 1] <= begin:
                    k += 1
                doc, first, start, tokens = self.docs[k]
                to = min(end, starts[k + 1])
                yield doc, start + begin - first, ids[begin:to], tokens, self.sequence, offset
                offset += to - begin
                begin = to
            self.sequence += 1
        while k < len(self.docs) and starts[k + 1] <= begin:
            k += 1
        left = [(d, max(0, f - begin), s + max(0, begin - f), n) for d, f, s, n in self.docs[k:]]
        self.docs, self.ids, self.size = left, [ids[begin:]], self.size - begin
        self.ends = (ends[ends > begin] - begin).tolist()
        self.stops = [soft[soft > begin] - begin]


def pack(
    df: DataFrame,
    tokenizer: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    end: int = 2,
    window: int = 4096,
    sentence_cost: float = 4.0,
    hard_cost: float = 16.0,
    block: int = 1 << 18,
) -> DataFrame:
    """Pack every row's tokens and a closing id ``end`` into sequences of at most ``window`` tokens.

    Returns one row per piece: the id column, start (the document's tokens before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset (place in the sequence).
    Every token is in exactly one piece and a sequence has no gaps. Cuts are chosen by dynamic
    programming over document ends (free), sentence ends (``sentence_cost``) and, in longer stretches
    without any, plain places (``hard_cost``), against one for each padding token; the last tokens
    of a task may be split at powers of two, which need no padding.

    Order is that of the rows of each input partition; nothing is shuffled, and a sequence holds
    rows of one partition. A partition read from files gives the same pieces when it is run again.
    Null and empty texts are the closing id alone; repeated rows are packed each; other columns are
    left out. ``tokenizer`` is a path that all executors have.
    """
    kept = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    key = kept.schema["id"]
    out = StructType([StructField(id, key.dataType)]).add("start", "long").add("length", "long").add("ids", "binary").add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        encoder = WordEncoder(tokenizer)  # of this task: what it remembers goes with it
        packer = Packer(window, sentence_cost, hard_cost, block)
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 40
        close = np.array([end], dtype=np.uint32)

        def pieces(last: bool) -> Iterator[pa.RecordBatch]:
            rows = [(d, s, len(i), i.astype("<u4").tobytes(), n, base + q, o) for d, s, i, n, q, o in packer.flush(last)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for part in slices(batch, "text", ROWS, BYTES):
                ids, sizes, stops, of = encoder.encode(part.column(1))
                begin = 0
                first = np.searchsorted(of, np.arange(len(sizes) + 1))
                for i, (doc, size) in enumerate(zip(part.column(0).to_pylist(), sizes.tolist())):
                    packer.add(doc, np.concatenate((ids[begin : begin + size], close)), stops[first[i] : first[i + 1]] - begin)
                    begin += size
                    if packer.full():
                        yield from pieces(False)
        yield from pieces(True)
        release()

    return kept.mapInArrow(run, out)
