"""A training corpus from ``documents``: language, repeated lines, near copies, benchmark passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontam, lines, near, packing
from tideline.llm.arrow import free
from tideline.llm.queries import identified
from tideline.session import settle

#: A document whose language is less likely than this, or that has no letters, is rejected.
LEAST_SCORE = 0.5


def beside(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with the columns that an operator would replace out of its way, and the list that puts them back."""
    held = {c: free(docs, c) for c in docs.columns if c in added}
    return docs.withColumnsRenamed(held), [F.col(held.get(c, c)).alias(c) for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; a missing ``lang`` is filled in.

    Null and empty texts and texts without a letter have no language and go. Repeated rows are judged alike. If no
    row has a ``lang`` nothing can be learnt and every row goes; an empty table stays one. Own columns called like
    those of the operator are kept as they are.
    """
    hidden, back = beside(docs, ("lang_pred", "score"))
    found = identified(hidden).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that stand earlier; ``n_chars`` follows the text.

    Nothing is repeated in null and empty texts, which stay. Of repeated rows and exact copies one keeps its
    text, the others are emptied. Own columns called like those of the operator are kept as they are.
    """
    hidden, back = beside(docs, ("removed_words", "removed_runs"))
    cut = lines.dedup_lines(hidden)
    return cut.withColumn("n_chars", F.when(F.col("removed_runs") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest id, ties by a hash.

    Texts without words (null, empty, emptied before) are copies of each other. Of repeated rows one stays. Null
    ids are larger than all others. No column is added or replaced.
    """
    return near.keep_first(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Null and empty texts are clean and stay; repeated rows are judged alike. An empty benchmark removes
    nothing. Own columns called like those of the operator are kept as they are.
    """
    hidden, back = beside(docs, ("n_words", "n_hit", "items", "spans", "contaminated"))
    scanned = decontam.decontaminate(hidden, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return scanned.where(~F.col("contaminated")).select(back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids (unsigned, little-endian, 32 bits).

    A null or empty text is the closing id alone; repeated rows are packed each. Other columns are left out.
    An empty table gives no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]
#: Learnt models, sketches and a tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
