"""Access to the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR = 3_600_000
MINUTE = 60_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Times in the tables carry no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_time(events: DataFrame) -> DataFrame:
    """Events with ``time`` in epoch milliseconds and ``cents`` as a whole number."""
    return events.withColumns({
        "time": F.unix_millis(F.col("ts").cast("timestamp")),
        "cents": F.round(F.col("value") * 100).cast("bigint"),
    })


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return with_time(table(spark, folder, "events"))


def of_type(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind)
