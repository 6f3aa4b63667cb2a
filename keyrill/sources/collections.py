"""Rows from a range or from literal values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sequence(spark: SparkSession, first: int, last: int, out: str = "v", partitions: int | None = None) -> DataFrame:
    """Whole numbers from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1, 1, partitions).withColumnRenamed("id", out)


def rows(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    """A frame of literal rows."""
    return spark.createDataFrame(values, schema)
