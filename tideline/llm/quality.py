"""Quality classifier: a byte-level convolutional network in numpy, over overlapping chunks of the whole text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import widen

#: Chunks convolved at a time.
STEP = 64


@dataclass(frozen=True)
class Shape:
    chunk: int = 256  # bytes of a chunk
    overlap: int = 32  # bytes that two neighbouring chunks share
    width: int = 6  # bytes a filter sees
    filters: int = 16
    hidden: int = 16


def chunks_of(text: bytes, shape: Shape) -> np.ndarray:
    """Overlapping chunks that cover the whole text, padded with zero bytes; one chunk for an empty text."""
    step = shape.chunk - shape.overlap
    count = max(1, -(-max(0, len(text) - shape.overlap) // step))
    raw = np.zeros(step * count + shape.overlap, dtype=np.uint8)
    raw[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.as_strided(raw, (count, shape.chunk), (step, 1)).copy()


class Network:
    """filters -> largest activation in each chunk -> hidden layer -> mean and largest over chunks -> one probability."""

    def __init__(self, shape: Shape, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.shape = shape
        self.params = {
            "filters": rng.normal(0, 0.3, (shape.width, 256, shape.filters)).astype(np.float32),
            "w1": rng.normal(0, 0.3, (shape.filters, shape.hidden)).astype(np.float32),
            "b1": np.zeros(shape.hidden, np.float32),
            "w2": rng.normal(0, 0.3, 2 * shape.hidden).astype(np.float32),
            "b2": np.zeros(1, np.float32),
        }

    def _convolve(self, chunks: np.ndarray) -> np.ndarray:
        table, span = self.params["filters"], self.shape.chunk - self.shape.width + 1
        out = table[0][chunks[:, :span]]
        for j in range(1, self.shape.width):
            out += table[j][chunks[:, j : j + span]]
        return out

    def pool(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, filters): the largest activation of each filter in each chunk."""
        parts = [self._convolve(chunks[i : i + STEP]).max(axis=1) for i in range(0, len(chunks), STEP)]
        return np.concatenate(parts) if parts else np.zeros((0, self.shape.filters), np.float32)

    def score(self, chunks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of each text; ``counts`` chunks belong to each, in order."""
        hidden = np.maximum(self.pool(chunks) @ self.params["w1"] + self.params["b1"], 0)
        begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
        both = np.concatenate((np.add.reduceat(hidden, begin, axis=0) / counts[:, None], np.maximum.reduceat(hidden, begin, axis=0)), axis=1)
        return 1 / (1 + np.exp(-(both @ self.params["w2"] + self.params["b2"]).astype(np.float64)))

    def gradient(self, chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        p, width = self.params, self.shape.width
        peaks, tops = [], []
        for i in range(0, len(chunks), STEP):
            out = self._convolve(chunks[i : i + STEP])
            at = out.argmax(axis=1)
            peaks.append(at)
            tops.append(np.take_along_axis(out, at[:, None, :], axis=1)[:, 0])
        at, top = np.concatenate(peaks), np.concatenate(tops)
        pre = top @ p["w1"] + p["b1"]
        hidden = np.maximum(pre, 0)
        begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
        most = np.maximum.reduceat(hidden, begin, axis=0)
        both = np.concatenate((np.add.reduceat(hidden, begin, axis=0) / counts[:, None], most), axis=1)
        guess = 1 / (1 + np.exp(-(both @ p["w2"] + p["b2"])))
        d_logit = ((guess - labels) * weights / weights.sum()).astype(np.float32)
        d_both = d_logit[:, None] * p["w2"]
        of = np.repeat(np.arange(len(counts)), counts)
        n = self.shape.hidden
        is_most = hidden == most[of]
        d_hidden = d_both[of, :n] / counts[of, None] + d_both[of, n:] * is_most / np.maximum(np.add.reduceat(is_most, begin, axis=0), 1)[of]
        d_pre = d_hidden * (pre > 0)
        d_top = d_pre @ p["w1"].T
        grad = {"w1": top.T @ d_pre, "b1": d_pre.sum(axis=0), "w2": both.T @ d_logit, "b2": d_logit.sum(keepdims=True)}
        table = np.zeros_like(p["filters"])
        row, column = np.arange(len(chunks))[:, None], np.arange(self.shape.filters)[None, :]
        for j in range(width):
            np.add.at(table[j], (chunks[row, at + j], column), d_top)
        return grad | {"filters": table}


def fit(network: Network, samples: Sequence[tuple[np.ndarray, int]], epochs: int = 24, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the log loss, both labels weighing the same, with a little weight decay."""
    rng = np.random.default_rng(seed)
    labels = np.array([y for _, y in samples], dtype=np.float32)
    share = min(max(labels.mean(), 0.01), 0.99) if len(labels) else 0.5
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    first = {k: np.zeros_like(v) for k, v in network.params.items()}
    second = {k: np.zeros_like(v) for k, v in network.params.items()}
    steps = 0
    total = epochs * -(-len(samples) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            counts = np.array([len(samples[k][0]) for k in part])
            grad = network.gradient(np.concatenate([samples[k][0] for k in part]), counts, labels[part], weight[part])
            steps += 1
            now = rate * (1 - 0.9 * steps / total)
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-7)
                network.params[k] -= (now * (move + 1e-3 * network.params[k])).astype(np.float32)
    return network


def _training_chunks(labelled: DataFrame, text: str, label: str, shape: Shape) -> list[tuple[np.ndarray, int]]:
    """All chunks of every row, on the driver."""

    def make():
        return lambda texts: ([chunks_of(t or b"", shape).tobytes() for t in texts],)

    rows = widen(labelled.select(text, F.col(label).cast("int").alias("y")), text, "x binary", make, ["y"], as_bytes=True).collect()
    return sorted(((np.frombuffer(x, np.uint8).reshape(-1, shape.chunk), y) for y, x in rows), key=lambda s: (s[1], s[0].tobytes()))


def learn(
    labelled: DataFrame,
    *,
    text: str = "text",
    label: str = "quality",
    order: str | Column = "doc_id",
    size: str | Column | None = None,
    sample_docs: int = 2000,
    sample_bytes: int = 16 << 20,
    epochs: int = 12,
    shape: Shape = Shape(),
) -> Network | None:
    """A network fitted to about ``sample_docs`` rows with a label, picked by a hash of ``order``.

    The rate comes from the number and the bytes of all labelled rows: about ``sample_docs`` rows and no more than about
    ``sample_bytes`` bytes of text. A picked row trains with its whole text, a very long one too. None if no row is
    labelled; null and empty texts are one chunk of padding.

    ``size`` is the column with the bytes of a text. Where ``labelled`` is a join, measure it before the join, so that
    numbers are dealt out to be counted and not whole texts.
    """
    known = labelled.where(F.col(label).isNotNull())
    size = F.octet_length(F.col(text).cast("string")) if size is None else size
    rows, total = known.agg(F.count("*"), F.sum(size)).first()
    if not rows:
        return None
    place = F.pmod(F.xxhash64(F.lit("quality"), order), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = min(1.0, sample_docs / rows, sample_bytes / (total or 1))
    samples = _training_chunks(known.where(place < rate), text, label, shape)
    return fit(Network(shape), samples, epochs=epochs) if samples else None


def score(docs: DataFrame, network: Network | None, *, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Add ``score``, the probability of label 1 of every whole text.

    Null and empty texts are one chunk of padding and get that chunk's score; without a network all
    scores are 0.5. Rows stay where they are, repeated rows score alike, and a column already called
    score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def make():
        net = shared.value

        def one(text: bytes | None) -> float:
            chunks = chunks_of(text or b"", net.shape)
            return float(net.score(chunks, np.array([len(chunks)]))[0])

        return lambda texts: ([one(t) if net else 0.5 for t in texts],)

    return widen(docs, text, "score double", make, carry, as_bytes=True)
