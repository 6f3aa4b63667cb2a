"""Rolling keyed aggregates: one output row per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.functions.ordering import Key, descending, names, with_keys
from keyrill.plans.running import Running, latest, position, previous, running, smallest, total
from keyrill.plans.slices import SLICE, plan_slices

Keys = Key | Sequence[Key] | None


def rolling(
    df: DataFrame, keys: Keys, order_by: str | Sequence[str], rows_per_slice: int | None = None, **values: Running
) -> DataFrame:
    """``df`` with running values per key in the given order (unique within a key)."""
    df, key_names = with_keys(df, keys)
    plan = plan_slices(df, key_names, order_by, rows_per_slice)
    return running(plan.assign(df), plan, **values).drop(SLICE)


def running_sum(df: DataFrame, keys: Keys, order_by, value: str, out: str = "running_sum", **options) -> DataFrame:
    return rolling(df, keys, order_by, **options, **{out: total(F.col(value))})


def running_max_by(df: DataFrame, keys: Keys, order_by, value: str, out: str = "max_row", **options) -> DataFrame:
    """The whole row of the largest value so far; of equal values the first one stays."""
    row = F.struct(*df.columns)
    rank = F.struct(
        F.col(value).isNull().alias("unknown"),
        descending(df, value).alias("rank"),
        *[F.col(o).alias(f"order_{i}") for i, o in enumerate(names(order_by))],
        row.alias("row"),
    )
    ranked = rolling(df, keys, order_by, **options, **{out: smallest(rank)})
    return ranked.withColumn(out, F.col(f"{out}.row"))


def last_value(df: DataFrame, keys: Keys, order_by, value: str, out: str = "previous", **options) -> DataFrame:
    """Rows passed through with the value the key held before them (null for the first)."""
    held = rolling(df, keys, order_by, **options, **{out: previous(F.col(value))})
    return held.withColumn(out, F.col(f"{out}.value"))


def running_counts(df: DataFrame, order_by, keys: Keys = None, rows_per_slice: int | None = None, **conditions: Column) -> DataFrame:
    """Running number of rows that meet each condition, over all rows or per key."""
    counts = {name: total(F.when(test, 1).otherwise(0).cast("long")) for name, test in conditions.items()}
    return rolling(df, keys, order_by, rows_per_slice, **counts)


def row_index(df: DataFrame, order_by, keys: Keys = None, out: str = "position", **options) -> DataFrame:
    """Position of each row from 1, over all rows or per key."""
    return rolling(df, keys, order_by, **options, **{out: position()})


__all__ = ["latest", "last_value", "rolling", "row_index", "running_counts", "running_max_by", "running_sum"]
