"""Lines of text, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files that appear in a folder. The folder can be replayed after a failure."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).withColumnRenamed("value", "line")


def stream_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines sent to a socket; for trying things out, as a socket cannot be replayed."""
    reader = spark.readStream.format("socket").option("host", host).option("port", port)
    return reader.load().withColumnRenamed("value", "line")
