"""Regrouping of two-column text: values per key, sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.operators.rolling import row_index

# Values a line holds at most; every group is cut into parts of this many values.
MAX_VALUES = 100_000


def parse_pairs(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated ``number, key`` lines as columns ``key`` and ``number``.

    A first field that is not an integer fails the job.
    """
    fields = F.split(F.col(line), "\t")
    return lines.select(fields[1].alias("key"), fields[0].cast("bigint").alias("number"))


def regroup(pairs: DataFrame, max_values: int = MAX_VALUES, rows_per_slice: int | None = None) -> DataFrame:
    """One line per key: the key and its numbers in order, separated by tabs.

    Duplicates stay. ``first`` is the smallest number as text, by which lines are to be
    ordered. A group comes in lines of ``max_values`` numbers, the last one shorter, numbered
    by ``part`` from 0; the numbers of all of them in order are the group.
    """
    # Equal numbers are alike, so any order between them gives the same line.
    placed = row_index(pairs, "number", "key", out="at", rows_per_slice=rows_per_slice)
    numbered = placed.withColumn("part", F.expr(f"(at - 1) div {int(max_values)}"))
    groups = numbered.groupBy("key", "part").agg(
        F.array_sort(F.collect_list("number")).alias("numbers")
    )
    smallest = F.min(F.element_at("numbers", 1)).over(Window.partitionBy("key"))
    line = F.concat_ws("\t", F.col("key"), F.array_join(F.col("numbers").cast("array<string>"), "\t"))
    return groups.select("key", "part", smallest.cast("string").alias("first"), line.alias("line"))


def regroup_sorted(pairs: DataFrame, **options) -> DataFrame:
    """:func:`regroup` in order of the first value as text, then the key."""
    return regroup(pairs, **options).orderBy("first", "key", "part")
