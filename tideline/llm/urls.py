"""URL filter: glob rules over canonical URLs, run by a bit-parallel Shift-And automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands between host and path in the canonical text; no host or path has it after `canonical`.
EDGE = "\x00"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host and its subdomains, a path prefix, and what to do with the urls under them."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def glob(self) -> str:
        """Over ``.host EDGE path``: ``?`` is a character, ``*`` a run on its side of the edge, ``\\`` quotes."""
        host, path = ("".join("\\" + c if c in "*?\\" else c for c in part) for part in (self.host, self.path))
        return f"*.{host}{EDGE}{path}*"


class ShiftAnd:
    """All globs at once: one bit for each pattern position, packed into 64-bit words.

    A position is entered from the one before it on its own byte (``step``) and kept on the bytes of
    a ``*`` that follows it (``loop``). ``?`` stands for one byte other than the edge.
    """

    def __init__(self, globs: Sequence[str]):
        step: list[set[int]] = []  # bytes that enter a position
        loop: list[set[int]] = []
        first, last = [], []
        inside = set(range(256)) - {ord(EDGE)}
        for glob in globs:
            first.append(len(step))
            step.append(set())  # the start of a pattern: entered from nothing, held by a leading `*`
            loop.append(set())
            chars = iter(glob)
            for c in chars:
                if c == "*":
                    loop[-1] |= inside
                elif c == "?":
                    step.append(set(inside))
                    loop.append(set())
                else:
                    for byte in (next(chars) if c == "\\" else c).encode():
                        step.append({byte})
                        loop.append(set())
            last.append(len(step) - 1)
        self.words = max(1, -(-len(step) // 64))
        self.first, self.last = np.array(first, dtype=np.int64), np.array(last, dtype=np.int64)
        self.step, self.loop = self._masks(step), self._masks(loop)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for i in first:
            self.start[i // 64] |= np.uint64(1 << (i % 64))

    def _masks(self, sets: list[set[int]]) -> np.ndarray:
        out = np.zeros((256, self.words), dtype=np.uint64)
        for i, members in enumerate(sets):
            out[sorted(members), i // 64] |= np.uint64(1 << (i % 64))
        return out

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean (texts, globs): which glob fits which whole text."""
        n = len(texts)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=n)
        order = np.argsort(-size, kind="stable")  # running texts stay a prefix of the rows
        begin = np.concatenate(([0], np.cumsum(size)))[:-1][order]
        size = size[order]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        state = np.repeat(self.start[None, :], n, axis=0)
        one, top = np.uint64(1), np.uint64(63)
        live = n
        for at in range(int(size[0]) if n else 0):
            live = int(np.searchsorted(-size[:live], -at, side="left"))
            now, byte = state[:live], data[begin[:live] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[byte]) | (now & self.loop[byte])
        hit = (state[:, self.last // 64] >> (self.last % 64).astype(np.uint64)) & one
        out = np.empty((n, len(self.last)), dtype=bool)
        out[order] = hit.astype(bool)
        return out


def canonical(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``.

    A null url, or one without ``://``, has an empty host and an empty path.
    """
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return df.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def judge(df: DataFrame, rules: Sequence[Rule], default: str = "allow", host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` (the longest that fits; of equal ones the first given; else null) and ``verdict``.

    The rules are a bounded parameter. Rows stay where they are: no shuffle. Null hosts and paths are
    taken as empty; repeated rows are judged alike; any other columns are carried along, but earlier
    columns called ``rule`` and ``verdict`` are replaced.
    """
    rules = list(rules)
    globs = [r.glob() for r in rules]
    rank = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    kept = df.drop("rule", "verdict")
    schema = kept.select("*", F.lit("").alias("rule"), F.lit("").alias("verdict")).schema
    for field in schema.fields:
        field.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd([globs[i] for i in rank])
        names = pa.array([rules[i].name for i in rank] + [None], pa.string())
        verdicts = pa.array([rules[i].verdict for i in rank] + [default], pa.string())
        for batch in batches:
            hosts, paths = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (host, path))
            texts = [f".{(h or '').replace(EDGE, ' ')}{EDGE}{(p or '').replace(EDGE, ' ')}".encode() for h, p in zip(hosts, paths)]
            fits = automaton.match(texts)
            best = pa.array(np.where(fits.any(axis=1), fits.argmax(axis=1), len(rank)) if len(rank) else np.zeros(len(texts), np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, names.take(best), verdicts.take(best)], names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)
