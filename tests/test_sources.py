from __future__ import annotations

import pytest
from conftest import rows
from fixtures import LINES
from pyspark.sql import functions as F

from tideline.session import shared_dir
from tideline.sources import kafka, log, offsets, synthetic, text
from tideline.streaming.feed import start_to_files


def test_text_round_trip_and_stream(spark):
    path = text.write_lines(spark.createDataFrame([(x,) for x in LINES], "line string").repartition(3), shared_dir(spark, "t"))
    assert rows(text.read_lines(spark, path)) == sorted([(x,) for x in LINES], key=repr)
    query = text.stream_lines(spark, path).writeStream.format("memory").queryName("lines").start()
    try:
        query.processAllAvailable()
        assert spark.table("lines").count() == 6
    finally:
        query.stop()


def test_parse_records(spark):
    raw = ["5,a,1.5", "  # skip", "", "6 , b, 2,extra", "x,c", "7,d,oops"]
    lines = spark.createDataFrame([(x,) for x in raw], "line string")
    out = text.parse_records(lines, {"event_time": "bigint", "key": "string", "v": "double"})
    assert rows(out) == sorted(
        [
            (5.0, "a", 1.5, []),
            (6.0, "b", 2.0, []),
            (None, "c", None, ["event_time"]),
            (7.0, "d", None, ["v"]),
        ],
        key=repr,
    )
    clean = text.format_records(out.where("event_time = 5"), ["event_time", "key", "v"])
    assert rows(clean) == [("5.0,a,1.5",)]


def test_synthetic_batch(spark):
    made = synthetic.synthetic_batch(spark, start_s=1_000, events_per_s=4, duration_s=3, lag_s=8)
    got = rows(made, "event_time", "seq", "key", "value")
    assert len(got) == 12
    assert (992.25, 1_000, "sensor-1", 1) in got
    assert {s for _, s, _, _ in got} == {1_000, 1_001, 1_002}


def test_synthetic_stream_has_the_same_columns(spark):
    stream = synthetic.synthetic_stream(spark, 5)
    assert stream.isStreaming and stream.columns == ["key", "value", "event_time", "seq", "ts"]


@pytest.mark.parametrize("n, chunk", [(64, 8), (65, 8), (1, 8), (100_003, 8)])
def test_split_ranges_tile_the_range(spark, n, chunk):
    chunks = offsets.split_ranges(spark.createDataFrame([(n,)], "n bigint"), "n", chunk)
    assert chunks.count() == -(-n // chunk)
    read = offsets.read_ranges(chunks, spread=True)
    assert read.agg(F.count("*"), F.countDistinct("offset"), F.min("offset"), F.max("offset")).first()[:] == (n, n, 0, n - 1)


def test_empty_range(spark):
    assert offsets.split_ranges(spark.createDataFrame([(0,)], "n bigint"), "n").count() == 0


def test_offset_source_has_one_partition_per_chunk(spark):
    spark.dataSource.register(offsets.OffsetRangeSource)
    df = spark.read.format("offset_range").option("stop", 64).option("chunk", 8).load()
    assert df.rdd.getNumPartitions() == 8
    digits = dict(rows(df.groupBy((F.col("offset") % 10).alias("d")).count()))
    assert digits == {d: 7 if d < 4 else 6 for d in range(10)}


def test_message_keys(spark):
    keys = [b"user-1", b"user-2", b"user-1", b"user-3", b"user-2", b"user-1", None, b""]
    messages = spark.createDataFrame([(k, b"click") for k in map(lambda k: k and bytearray(k) if k else k, keys)], "key binary, value binary")
    counts = kafka.decode_user(messages).groupBy("user").count().withColumnRenamed("count", "n")
    assert rows(counts) == [("unknown", 2), ("user-1", 3), ("user-2", 2), ("user-3", 1)]
    assert ("anon",) in rows(kafka.decode_user(messages, "anon").select("user"))
    sent = kafka.encode_counts(counts)
    assert dict(sent.dtypes) == {"key": "binary", "value": "binary"}
    assert rows(sent.select(F.decode("value", "UTF-8"))) == [("1",), ("2",), ("2",), ("3",)]


def test_kafka_options():
    assert kafka.source_options("h:1", ["a", "b"]) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest",
    }
    assert kafka.sink_options("h:1", "out")["topic"] == "out"


def test_log_is_read_in_spans_and_where_it_was_left(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "id bigint, label string"
    rows_of = lambda a, b: spark.range(a, b, 1, 2).select("id", F.concat(F.lit("r"), "id").alias("label"), F.lit(1).alias("unused"))
    log.append_log(rows_of(0, 25), path, 0)
    log.append_log(rows_of(25, 60), path, 1)
    (tmp_path / "log" / log.folder_of(2)).mkdir()  # begun, not complete
    whole = log.read_log(spark, path, schema, rows_per_partition=7)
    assert sorted((r.id, r.label) for r in whole.collect()) == [(i, f"r{i}") for i in range(60)]

    def run():
        stream = log.read_log(spark, path, schema, stream=True, rows_per_partition=7)
        query = start_to_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.processAllAvailable()
        query.stop()
        return sorted(r.id for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())

    assert run() == list(range(60))
    assert run() == list(range(60))
    log.append_log(rows_of(60, 61), path, 2)
    log.append_log(rows_of(61, 61), path, 3)
    log.append_log(rows_of(61, 90), path, 4)
    assert run() == list(range(90))


def test_a_span_reads_only_its_rows(spark, tmp_path):
    spark.range(0, 100, 1, 1).write.option("parquet.block.size", 64).parquet(str(tmp_path / log.folder_of(0)))
    reader = log._LogReader({"path": str(tmp_path), "rowsPerPartition": "30"}, spark.range(1).schema)
    spans = reader.partitions()
    assert [(s.first, s.last) for s in spans] == [(0, 30), (30, 60), (60, 90), (90, 100)]
    batches = [list(reader.read(s)) for s in spans]
    assert [[x for b in part for x in b.column(0).to_pylist()] for part in batches] == [list(range(s.first, s.last)) for s in spans]
    assert all(len(part) == 1 for part in batches)
