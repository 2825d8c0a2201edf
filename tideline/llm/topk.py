"""Exact top-k inner products: a ball tree in each shard, searched by branch and bound."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import settle


@dataclass
class Ball:
    center: np.ndarray
    radius: float
    rows: np.ndarray | None  # of a leaf
    left: Ball | None = None
    right: Ball | None = None


def grow(vectors: np.ndarray, rows: np.ndarray, leaf: int) -> Ball:
    """A ball tree over some rows: each ball is halved along the line between two far points."""
    mine = vectors[rows]
    center = mine.mean(axis=0)
    away = ((mine - center) ** 2).sum(axis=1)
    ball = Ball(center, float(np.sqrt(away.max())), rows)
    if len(rows) > leaf and ball.radius > 0:
        a = mine[away.argmax()]
        b = mine[((mine - a) ** 2).sum(axis=1).argmax()]
        side = np.argsort(mine @ (b - a), kind="stable")
        half = len(rows) // 2
        ball.rows, ball.left, ball.right = None, grow(vectors, rows[side[:half]], leaf), grow(vectors, rows[side[half:]], leaf)
    return ball


class Search:
    """The k best of the rows seen so far for every query of a block; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
        self.queries, self.ids, self.k = queries, ids, k
        self.norm = np.sqrt((queries**2).sum(axis=1))
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = floor  # a score that k rows of other shards already reach, or -inf

    def kth(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def bound(self, ball: Ball, active: np.ndarray) -> np.ndarray:
        """No row of the ball scores more; widened by what rounding could take."""
        top = self.queries[active] @ ball.center + self.norm[active] * ball.radius
        return top + 1e-6 * (1 + self.norm[active] * (ball.radius + np.sqrt((ball.center**2).sum())))

    def visit(self, ball: Ball, vectors: np.ndarray, ids: np.ndarray, active: np.ndarray) -> None:
        """Search a ball for the queries it can still help, the more promising half first."""
        active = active[self.bound(ball, active) >= self.kth()[active]]
        if not len(active):
            return
        if ball.rows is None:
            children = sorted((ball.left, ball.right), key=lambda child: -self.bound(child, active).max())
            for child in children:
                self.visit(child, vectors, ids, active)
            return
        scores = self.queries[active] @ vectors[ball.rows].T
        own = ids[ball.rows]
        scores[self.ids[active][:, None] == own[None, :]] = -np.inf
        both = np.concatenate((self.score[active], scores), axis=1)
        who = np.concatenate((self.found[active], np.broadcast_to(own, scores.shape)), axis=1)
        best = np.lexsort((who, -both), axis=1)[:, : self.k]
        self.score[active] = np.take_along_axis(both, best, axis=1)
        self.found[active] = np.take_along_axis(who, best, axis=1)


def _numbers(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def search_shard(queries: pd.DataFrame, rows: pd.DataFrame, k: int, leaf: int) -> pd.DataFrame:
    """Best rows of one shard for one block of queries: (query_id, vec_id, score)."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if not len(queries) or not len(rows):
        return empty
    vectors, ids = _numbers(rows["v"]), rows["vec_id"].to_numpy(np.int64)
    # Sums of products below 2**53 are exact in floating point.
    search = Search(_numbers(queries["v"]), queries["vec_id"].to_numpy(np.int64), k, queries["floor"].to_numpy(np.float64))
    search.visit(grow(vectors, np.arange(len(ids)), leaf), vectors, ids, np.arange(len(queries)))
    good = np.isfinite(search.score) & (search.score >= search.floor[:, None])
    at = np.repeat(np.arange(len(queries)), k).reshape(good.shape)[good]
    return pd.DataFrame({"query_id": search.ids[at], "vec_id": search.found[good], "score": search.score[good].astype(np.int64)})


def whole_numbers(df: DataFrame, id: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; vectors null or with a null or non-finite component are out."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    kept = df.where(F.col(vector).isNotNull() & F.col(id).isNotNull()).select(F.col(id).cast("long").alias("vec_id"), x.alias("x"), F.coalesce(bad, F.lit(True)).alias("bad"))
    return kept.where(~F.col("bad")).select("vec_id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))


def top_k(
    df: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    every: int = 50,
    k: int = 5,
    scale: float = 256.0,
    shard_rows: int = 8192,
    block_rows: int = 2048,
    leaf: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its ``k`` best other rows.

    Components become whole numbers floor(``scale`` * x); the score is their inner product, ties go
    to the smaller id, fewer rows come back if there are fewer. Vectors that are null or hold a null
    or non-finite component, and rows without an id, take no part; vectors of another length than
    the query's are no candidates. Repeated rows count once, and a row with the query's id is its
    own. Scores are exact while they stay below 2**53. Other columns are left out.

    Rows are dealt into shards of about ``shard_rows`` and queries into blocks of about
    ``block_rows`` by hashes; each pair of a block and a shard is one group of bounded size. A query
    first searches the shard it is dealt to, and the k-th score found there is its floor in all
    others: subtrees that cannot reach it are not entered.
    """
    rows = whole_numbers(df, id, vector, scale).distinct()
    rows = settle(rows.withColumn("dim", F.size("v")), "topk-rows")
    total = rows.count()
    shards = max(1, -(-total // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // block_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("v", "vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    out = "query_id long, vec_id long, score long"

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_shard(left, right, k, leaf)

    def search(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        keys = ["dim", "block", "shard"]
        return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, out)

    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    dealt = settle(rows.withColumn("block", all_blocks), "topk-dealt")
    first = settle(search(asked.withColumn("floor", F.lit(float("-inf"))), dealt), "topk-first")
    # The k-th score of the own shard: the smallest of k found.
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
    known = asked.drop("shard").join(floors.select(F.col("query_id").alias("vec_id"), F.col("s").cast("double").alias("floor")), "vec_id", "left")
    known = known.withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))).withColumn("shard", all_shards)
    found = search(known, dealt).union(first).distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
