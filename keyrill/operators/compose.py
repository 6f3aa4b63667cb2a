"""Putting several inputs together, and placing rows on partitions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of inputs with the same columns; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


def connect(
    left: DataFrame,
    right: DataFrame,
    on_left: Callable[[DataFrame], DataFrame],
    on_right: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two inputs of different types, each through its own function to a common type."""
    return on_left(left).unionByName(on_right(right))


def partition_custom(df: DataFrame, count: int, partition: Column, tasks_each: int = 1) -> DataFrame:
    """Place each row on the partition its expression names; fail outside 0..count-1.

    With ``tasks_each`` a partition is several of Spark's, over which a hash of the row deals its rows; ``partition_number``
    with the same number tells which one a row is on.
    """
    number = partition.cast("int")
    message = F.concat(F.lit(f"partition out of 0..{count - 1}: "), F.coalesce(number.cast("string"), F.lit("null")))
    checked = F.when(number.between(0, count - 1), number).otherwise(F.raise_error(message).cast("int"))
    dealt = F.pmod(F.xxhash64(*df.columns), F.lit(tasks_each)).cast("int") if tasks_each > 1 else F.lit(0)
    return df.repartitionById(count * tasks_each, checked * tasks_each + dealt)


def partition_number(tasks_each: int = 1) -> Column:
    """The partition of ``partition_custom`` that a row is on."""
    return F.floor(F.spark_partition_id() / tasks_each).cast("int")


def sort_partitions(df: DataFrame, *order_by: str | Column, position: str | None = None) -> DataFrame:
    """Sort the rows of each of Spark's partitions, without a shuffle; ``position`` names a column for their numbers, from 0."""
    placed = df.sortWithinPartitions(*order_by)
    if position is None:
        return placed
    # The number of a row in its partition is the low 33 bits of this id.
    return placed.withColumn(position, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))


def set_parallelism(df: DataFrame, count: int, *keys) -> DataFrame:
    """Spread rows over ``count`` tasks, by key if keys are given."""
    return df.repartition(count, *keys)
