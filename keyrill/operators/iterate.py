"""Iteration with feedback."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.session import work_dir

ROUNDS_PER_JOB = 64
FLYING = "_flying"


def iterate(
    df: DataFrame,
    step: Callable[[Column], Column],
    output: Callable[[Column], Column],
    feedback: Callable[[Column], Column],
    max_iterations: int,
    rounds_per_job: int = ROUNDS_PER_JOB,
) -> DataFrame:
    """Emit every row that meets ``output`` and feed ``step`` of it back into the loop.

    The functions take the row as a struct column; ``step`` gives a struct of the same
    fields. Only rows that meet ``feedback`` go round again: it must become false for
    rows that can lead to no more output, otherwise rows are still in flight after
    ``max_iterations`` and the call raises.

    One job runs ``rounds_per_job`` rounds over a row at once, without a shuffle, and
    writes its output and the rows in flight to the shared folder: the step runs once per
    row and round, the plan stays short and a lost executor reads the rows back.
    """
    spark = df.sparkSession
    folder = work_dir(spark, "iterate")
    current, done, job = df, 0, 0
    outputs: list[DataFrame] = []

    def go_round(trail: Column, _: Column) -> Column:
        row = F.element_at(trail, -1)
        return F.when(feedback(row), F.concat(trail, F.array(step(row)))).otherwise(trail)

    while True:
        rounds = min(rounds_per_job, max_iterations - done)
        start = F.array(F.struct(*df.columns))
        turns = F.sequence(F.lit(1), F.lit(rounds))
        trail = current.select(F.reduce(turns, start, go_round).alias("trail"))
        # A trail is never empty; the outer form keeps Spark from testing that by building it again.
        seen = trail.select(F.posexplode_outer("trail").alias("turn", "row")).withColumn("flying", F.col("turn") == rounds)
        kept = seen.filter(F.col("flying") | output(F.col("row"))).select("row.*", F.col("flying").cast("int").alias(FLYING))
        path = f"{folder}/job={job}"
        kept.write.partitionBy(FLYING).parquet(path)
        written = spark.read.schema(kept.schema).parquet(path)
        outputs.append(written.filter(F.col(FLYING) == 0).drop(FLYING))
        current = written.filter(F.col(FLYING) == 1).drop(FLYING)
        done += rounds
        job += 1
        if current.isEmpty():
            return reduce(DataFrame.unionByName, outputs)
        if done >= max_iterations:
            raise RuntimeError(f"rows still in flight after {max_iterations} iterations")
