"""Late rows to a place of their own.

A row is late if its time is not after the watermark of its micro-batch, the latest time of the batches before less
the delay. Rows are parted before any stateful work: those on time go on, with the watermark they came under, late ones
go to a second folder. The watermark of each micro-batch is in a log under its number, written before its rows, so a batch that is
run again finds the same one and writes the same rows in the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HORIZON = "horizon"
LOG = "watermark bigint, latest bigint, earliest bigint"


def part_late(folder: str, time: str, delay: int) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: rows on time to ``folder/on_time``, late ones to ``folder/late``, the log to ``folder/log``.

    ``time`` is a whole-number column, ``delay`` in its unit. Rows without time are late.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        low, high = batch.agg(F.min(time), F.max(time)).head()
        before = spark.read.schema(LOG).parquet(f"{folder}/log/batch={number - 1}").head() if number else None
        known = before and before["latest"] is not None
        watermark = before["latest"] - delay if known else None
        latest = max((t for t in (high, before and before["latest"]) if t is not None), default=None)
        spark.createDataFrame([(watermark, latest, low)], LOG).coalesce(1).write.mode("overwrite").parquet(f"{folder}/log/batch={number}")
        # Before the first watermark all rows are on time.
        horizon = F.lit(watermark if known else (low or 0) - 1).cast("long")
        on_time = F.coalesce(F.col(time) > horizon, F.lit(False))
        batch.filter(on_time).withColumn(HORIZON, horizon).write.mode("overwrite").parquet(f"{folder}/on_time/batch={number}")
        batch.filter(~on_time).write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        batch.unpersist()

    return store


def on_time_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows on time as a stream, with their ``horizon``: no row on time that follows is at or before it.

    A watermark on the horizon, less a little, drops none of them, however the files are cut into micro-batches
    (``progress`` of ``ordered_state``, with a delay of a millisecond).
    """
    return spark.readStream.schema(StructType(schema.fields).add(HORIZON, "long")).parquet(f"{folder}/on_time/*")


def late_rows(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/late/*")
