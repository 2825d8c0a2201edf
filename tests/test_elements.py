from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from conftest import rows
from fixtures import CITIES, LINES, timed
from pyspark.sql import functions as F

from tideline.functions.text import clock
from tideline.operators import aggregate as agg
from tideline.operators import elementwise as el


def test_word_count(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "text string")
    counts = dict(rows(agg.count_per_key(el.split_words(lines), "word")))
    assert sum(counts.values()) == 35 and len(counts) == 19
    assert {w: counts[w] for w in ("the", "tide", "in", "out", "a", "doesn't", "bay", "end")} == {
        "the": 6, "tide": 4, "in": 3, "out": 3, "a": 2, "doesn't": 2, "bay": 2, "end": 1,
    }


def test_score_and_keep(spark):
    cities = spark.createDataFrame(CITIES, "city string, qty bigint")
    kept = cities.transform(el.score_and_keep(20))
    assert rows(kept, "city", "score") == [("Bern", 36), ("Oslo", 28), ("Reykjavik", 36)]


def test_batches_share_one_client_per_task_and_close_it(spark):
    fruits = ["apple", "banana", "cherry", "date", "elderberry"]
    data = [(i, fruits[i % 5], i * 7 % 13) for i in range(20)]
    df = spark.createDataFrame(data, "id bigint, fruit string, qty bigint").where("fruit != 'date'")

    class Client:
        closed = False

        def close(self):
            self.closed = True

    def enrich(client, batch):
        assert not client.closed
        return pa.RecordBatch.from_arrays([batch.column("id"), pc.multiply(batch.column("qty"), 2)], ["id", "twice"])

    out = el.enrich_in_batches(df, Client, enrich, "id bigint, twice bigint")
    assert rows(out) == sorted([(i, 2 * q) for i, f, q in data if f != "date"], key=repr)
    assert out.count() == 16


def test_anatomy(spark):
    df = timed(spark, [(3_725,)], "s bigint")
    assert rows(el.element_anatomy(df, 3_600), "event_s", "window_start_s", "window_end_s", "timing") == [
        (3_725, 3_600, 7_200, "UNKNOWN")
    ]
    assert rows(el.element_anatomy(df), "window_start_s", "window_end_s") == [(None, None)]
    assert rows(df.select(clock(F.col("ts")))) == [("01:02:05",)]
