"""Tumbling count windows. Only full windows give a result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.functions.ordering import names, with_keys
from keyrill.operators.rolling import Keys, row_index

WINDOW = "window_no"


def number_windows(
    df: DataFrame, keys: Keys, order_by: str | Sequence[str], size: int, rows_per_slice: int | None = None
) -> DataFrame:
    """Each row with its window number, from 0 per key (or over all rows without keys)."""
    placed = row_index(df, order_by, keys, out="_at", rows_per_slice=rows_per_slice)
    return placed.withColumn(WINDOW, F.expr(f"(_at - 1) div {int(size)}")).drop("_at")


def count_window_agg(df: DataFrame, keys: Keys, order_by, size: int, *aggregates: Column, **options) -> DataFrame:
    """Full windows with built-in aggregates."""
    df, key_names = with_keys(df, keys)
    grouped = number_windows(df, key_names, order_by, size, **options).groupBy(*key_names, WINDOW)
    return grouped.agg(F.count(F.lit(1)).alias("_n"), *aggregates).filter(F.col("_n") == size).drop("_n")


def count_window_rows(df: DataFrame, keys: Keys, order_by, size: int, out: str = "rows", **options) -> DataFrame:
    """Full windows with their rows as an ordered array of ``size`` structs."""
    rank = [F.col(o).alias(f"order_{i}") for i, o in enumerate(names(order_by))]
    entry = F.struct(*rank, F.struct(*df.columns).alias("row"))
    collected = count_window_agg(df, keys, order_by, size, F.collect_list(entry).alias(out), **options)
    return collected.withColumn(out, F.transform(F.array_sort(out), lambda e: e["row"]))


def count_window_reduce(
    df: DataFrame, keys: Keys, order_by, size: int, reduce: Callable[[Column, Column], Column], out: str = "result", **options
) -> DataFrame:
    """Fold the rows of each full window, in order, with ``reduce(so_far, row)``."""
    windows = count_window_rows(df, keys, order_by, size, **options)
    rest = F.slice("rows", 2, size - 1) if size > 1 else F.filter("rows", lambda r: F.lit(False))
    return windows.withColumn(out, F.reduce(rest, F.col("rows")[0], reduce)).drop("rows")


def count_window_aggregate(
    df: DataFrame,
    keys: Keys,
    order_by,
    size: int,
    zero: Column,
    add: Callable[[Column, Column], Column],
    finish: Callable[[Column], Column] | None = None,
    out: str = "result",
    **options,
) -> DataFrame:
    """Fold each full window from an empty accumulator: ``add(accumulator, row)``, then ``finish``."""
    windows = count_window_rows(df, keys, order_by, size, **options)
    folded = F.reduce("rows", zero, add, finish) if finish else F.reduce("rows", zero, add)
    return windows.withColumn(out, folded).drop("rows")


def count_window_process(df: DataFrame, keys: Keys, order_by, size: int, function, schema, **options) -> DataFrame:
    """Whole-window function in Python over many windows at once: ``function(batch) -> batch``.

    The Arrow batch has the key columns, the window number and ``rows``, for each window a list
    of exactly ``size`` structs in order.
    """
    windows = count_window_rows(df, keys, order_by, size, **options)

    def run(batches):
        for batch in batches:
            yield function(batch)

    return windows.mapInArrow(run, schema)
