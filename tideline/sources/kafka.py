"""Message-log source and sink: the option mapping and the byte codec around it.

Offsets live in the query's checkpoint, never in the consumer group. The connector is a separate jar;
any frame with ``key BINARY, value BINARY`` stands in for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.wire import key_text, to_bytes


def source_options(bootstrap: str, topics: list[str], starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }


def sink_options(bootstrap: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def read_topic(spark: SparkSession, bootstrap: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    reader = spark.readStream.format("kafka").options(**source_options(bootstrap, topics, starting))
    return reader.load().select("key", "value", "timestamp")


def write_topic(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str):
    return (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .options(**sink_options(bootstrap, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def decode_user(messages: DataFrame, default: str = "unknown") -> DataFrame:
    """Add ``user`` from the key bytes."""
    return messages.withColumn("user", key_text(F.col("key"), default))


def encode_counts(counts: DataFrame, user: str = "user", n: str = "n") -> DataFrame:
    """Replace user and count by key and value bytes; other columns stay."""
    return counts.withColumns({"key": to_bytes(F.col(user)), "value": to_bytes(F.col(n))}).drop(user, n)
