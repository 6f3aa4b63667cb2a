"""Kafka topics as streams of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str, topic: str, group: str | None = None, start: str = "earliest", max_offsets: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Records of a topic. Needs the Kafka connector of Spark on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def decode_messages(records: DataFrame, event_time: Column | None = None) -> DataFrame:
    """Records as ``message`` text and ``event_time`` in epoch milliseconds.

    The time is the record's own timestamp unless another is given; pass
    ``current_timestamp()`` to stamp messages on arrival.
    """
    stamp = F.col("timestamp") if event_time is None else event_time
    return records.select(
        F.col("value").cast("string").alias("message"), F.unix_millis(stamp.cast("timestamp")).alias("event_time")
    )


def bounded_lateness(df: DataFrame, time: str, delay: str = "24 hours") -> DataFrame:
    """Event time on a timestamp column; rows more than ``delay`` behind are late."""
    return df.withWatermark(time, delay)
