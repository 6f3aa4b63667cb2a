"""Iteration whose feedback crosses rows: a solution set and the part of it that changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.session import work_dir


def delta_iterate(
    start: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    key: str,
    value: str,
    max_iterations: int,
) -> DataFrame:
    """The least ``value`` of every ``key`` that ``start`` holds or that ``step`` leads to.

    ``step`` takes the rows (key, value) that the round before changed and gives rows it offers for the next one, by joins or
    aggregates of its own. An offer counts if its key is new or its value is less than what the solution holds. Values may be
    of any type with an order, structs too; rows without a value are left out, a null key is a key like others.

    Only changed rows go round. Each round appends them to the shared folder, and the solution is the minimum over what
    was written, so plans stay short and a lost executor reads files. The loop ends when a round changes
    nothing; after ``max_iterations`` rounds that still change something the call raises.
    """
    spark = start.sparkSession
    folder = work_dir(spark, "delta")
    paths: list[str] = []

    def least(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value))

    changed = least(start.select(key, value))
    schema = changed.schema
    while True:
        path = f"{folder}/{len(paths)}"
        changed.write.parquet(path)
        paths.append(path)
        changed = spark.read.schema(schema).parquet(path)
        solution = least(spark.read.schema(schema).parquet(*paths))
        if changed.isEmpty():
            return solution
        if len(paths) > max_iterations:
            raise RuntimeError(f"rows still change after {max_iterations} iterations")
        held = solution.select(F.col(key).alias("_key"), F.col(value).alias("_held"))
        offered = least(step(changed).select(key, value)).join(held, F.col(key).eqNullSafe(F.col("_key")), "left")
        changed = offered.filter(F.col("_held").isNull() | (F.col(value) < F.col("_held"))).select(key, value)
