"""Running streaming queries over bounded input, to the end."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyrill.session import ROCKSDB, work_dir


# Bytes of input per micro-batch; results do not depend on it.
BYTES_PER_BATCH = 1 << 30


def stream_table(
    spark: SparkSession,
    folder: str,
    name: str,
    max_files: int | None = None,
    max_bytes: int = BYTES_PER_BATCH,
    schema: StructType | None = None,
) -> DataFrame:
    """A stream of the parquet files ``name*.parquet`` of a folder, oldest first.

    A micro-batch takes ``max_files`` files if given, else ``max_bytes`` of input.
    """
    known = schema or spark.read.option("pathGlobFilter", f"{name}*.parquet").parquet(folder).schema
    reader = spark.readStream.schema(known).option("pathGlobFilter", f"{name}*.parquet")
    limit = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", max_bytes)
    return reader.option(*limit).parquet(folder)


def disorder(spark: SparkSession, folder: str, name: str, time: Column, per_ms: int = 1) -> int:
    """How far, in milliseconds, a file of ``stream_table`` may lie before files read earlier.

    For each file, the latest time in it and in files not younger, less its own earliest;
    the largest of these, and a little for rounding. ``time`` is a whole number of ``per_ms``
    units a millisecond. One row per file is compared.
    """
    rows = spark.read.option("pathGlobFilter", f"{name}*.parquet").parquet(folder)
    files = rows.groupBy("_metadata.file_path", "_metadata.file_modification_time").agg(
        F.min(time).alias("low"), F.max(time).alias("high")
    )
    earlier = Window.orderBy("file_modification_time").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = files.select((F.max("high").over(earlier) - F.col("low")).alias("d")).agg(F.max("d")).head()[0]
    return -(-(found or 0) // per_ms) + 2


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """RocksDB state, and one state partition per core unless told otherwise.

    The settings are read when a query starts and are put back after.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_to_parquet(stream: DataFrame, folder: str, name: str | None = None, partitions: int | None = None):
    """Start an append query over all available input into ``folder/out``."""
    writer = stream.writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    with state_settings(stream.sparkSession, partitions):
        return writer.option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/out")


def run_until_idle(stream: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Run a stream until it meets no more input, then stop it; the rows it appended.

    For state that expires by the clock: such a query keeps running empty batches, so it
    never ends by itself.
    """
    spark = stream.sparkSession
    folder = work_dir(spark, name)
    writer = stream.writeStream.outputMode("append").format("parquet")
    with state_settings(spark, partitions):
        query = writer.option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/out")
    try:
        while query.isActive:
            progress = query.lastProgress
            if progress and progress["batchId"] > 0 and progress["numInputRows"] == 0:
                break
            time.sleep(0.2)
        failure = query.exception()
        if failure:
            raise failure
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_append(stream: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Run a stream over its available input; the rows it appended."""
    spark = stream.sparkSession
    folder = work_dir(spark, name)
    start_to_parquet(stream, folder, partitions=partitions).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_flushed(
    spark: SparkSession,
    data: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    last_row: dict,
    name: str,
    partitions: int | None = None,
    sink: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
) -> DataFrame | str:
    """Run ``build(data)`` to the end of its input, then push event time to the end.

    With a ``sink``, its function for ``foreachBatch`` takes the rows, and the folder it was made for is returned.

    After the data a single row ``last_row`` arrives, under a key of its own and far
    ahead in time. It moves the watermark past every open window and timer; it never
    fires its own, as nothing moves the watermark past it. The second run resumes from
    the checkpoint of the first.
    """
    folder = work_dir(spark, name)
    closing = f"{folder}/closing"
    row = spark.createDataFrame([tuple(last_row.get(f.name) for f in data.schema)], data.schema)
    row.limit(0).write.parquet(closing)
    closer = spark.readStream.schema(data.schema).parquet(closing)
    stream = build(data.unionByName(closer))

    def run() -> None:
        if sink is None:
            start_to_parquet(stream, folder, partitions=partitions).awaitTermination()
            return
        writer = stream.writeStream.foreachBatch(sink(folder)).trigger(availableNow=True)
        with state_settings(spark, partitions):
            query = writer.option("checkpointLocation", f"{folder}/checkpoint").start()
        query.awaitTermination()

    run()
    row.coalesce(1).write.mode("append").parquet(closing)
    run()
    if sink is not None:
        return folder
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
