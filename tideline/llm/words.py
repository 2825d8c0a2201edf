"""Words of many texts as 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tideline.llm.arrow import values

#: Every ASCII character that is no digit or lower-case letter becomes a space.
SPACED = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


#: Which bytes are no ASCII white space.
SOLID = np.array([c != 0x20 and not 0x09 <= c <= 0x0D for c in range(256)])
#: The lowest bytes of eight, by their number.
LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of a word that are hashed eight at a time for many words at once; longer words are hashed each by itself.
SHORT = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coded(texts: Sequence[str | None], table: bytes | None = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words, all words in a row as places among them, and where each text's words begin.

    The last array has one more entry for the end. ``table`` says which byte stands for each; with None words are
    parted by white space alone.
    """
    folded = [t.lower().encode().translate(table) if t else b"" for t in texts]
    lists = pc.ascii_split_whitespace(pa.array(folded, pa.binary()).cast(pa.string()))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    words = lists.flatten().dictionary_encode()
    distinct = values(words.dictionary.cast(pa.binary()))
    of = np.fromiter(map(xxhash.xxh64_intdigest, distinct), dtype=np.uint64, count=len(distinct))
    index = words.indices.to_numpy(zero_copy_only=False)
    solid = np.fromiter(map(bool, distinct), dtype=bool, count=len(distinct))[index]
    edge = np.concatenate(([0], np.cumsum(solid)))[np.concatenate(([0], np.cumsum(counts)))]
    return of, index[solid], edge


def hashed(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words in a row, and where each text's words begin (one more entry at the end)."""
    of, index, edge = coded(texts)
    return of[index], edge


def spaced(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Like ``hashed``, for words parted by ASCII white space alone; no word is looked up, so many distinct ones cost no more."""
    folded = [t.lower().encode() if t else b"" for t in texts]
    raw = np.frombuffer(b" ".join((b"", *folded, b" " * 8)), np.uint8)
    solid = SOLID[raw]
    ends = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    begin, size = ends[::2], ends[1::2] - ends[::2]
    edge = np.searchsorted(begin, np.cumsum([1, *(len(t) + 1 for t in folded)]))
    eight = np.ndarray(len(raw) - 7, "<u8", raw.data, strides=(1,))
    out, rest = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(len(size))
    for at in range(0, SHORT, 8):
        left = size[rest] - at
        out[rest] = mix(out[rest] + mix(eight[begin[rest] + at] & LOWEST[np.minimum(left, 8)]))
        rest = rest[left > 8]
    for i in rest.tolist():
        out[i] = xxhash.xxh64_intdigest(raw[begin[i] : begin[i] + size[i]])
    return out, edge


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words of one text; of all its words if it has fewer, none if it has none."""
    width = min(width, len(words))
    if not width:
        return words[:0]
    size = len(words) - width + 1
    out = np.zeros(size, dtype=np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + size]
    return mix(out)


def labelled(values: np.ndarray) -> np.ndarray:
    """Each value joined with the number of its occurrence, so that repeats differ; first occurrences stay as they are."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(values) else np.zeros(0, bool)
    if new.all():
        return values
    place = np.arange(len(values))
    nth = np.empty(len(values), dtype=np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.where(nth > 0, mix(values + nth * np.uint64(0xD1B54A32D192ED03)), values)
