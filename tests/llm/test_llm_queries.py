"""The operators' queries against their SQL, and the pipeline's stages against their rules, at the smallest scale."""

from __future__ import annotations

import corpus_pipeline
import pytest
from check import compare, duck
from pyspark.sql import functions as F

from tideline.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_keep_their_promises(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == columns
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids, kept = {r.doc_id for r in docs.collect()}, [r.doc_id for r in after.collect()]
        assert set(kept) <= ids and len(set(kept)) == len(kept)
        if name in ("language_id", "line_dedup"):
            assert len(kept) == before  # every document has letters
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, FOLDER).groupBy("doc_id").count().count() == docs.count()


def test_pipeline_stages_on_awkward_rows(spark):
    """Nulls, empty texts, repeated rows, an empty table, and own columns called like those of the operators."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    clash = ["score", "lang_pred", "removed_words", "removed_runs", "n_words", "n_hit", "items", "spans", "contaminated", "k", "hits"]
    mine = {c: F.lit(f"own {c}") for c in clash}
    odd = spark.createDataFrame([(9001, None, "en", "x", 0), (9002, "", None, "x", 0), (9003, "½ ² Ⅷ ①", "en", "x", 7), (None, "the thing", "en", None, None)], docs.schema)
    rows = docs.union(odd).union(docs.limit(5)).withColumns(mine)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, rows.limit(0), FOLDER)
        assert none.count() == 0
        if name == "packing":
            continue
        kept = stage(spark, rows, FOLDER)
        assert kept.columns == rows.columns == none.columns
        found = kept.collect()
        assert all(r[c] == f"own {c}" for r in found for c in clash), name
        ids = {r.doc_id for r in found}
        assert (9001 in ids, 9003 in ids) == ((False, False) if name == "language_id" else (True, True)), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER)
    assert pieces.filter("start = 0").count() == rows.count()
    assert pieces.filter("doc_id in (9001, 9002)").agg(F.sum("length")).first()[0] == 2
