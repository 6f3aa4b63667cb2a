"""Batch forms of the timer operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.functions.ordering import names
from keyrill.plans.running import following, position, running
from keyrill.plans.slices import plan_slices


def idle_timeout_count(
    df: DataFrame, keys, time: str, idle: int, order_by, rows_per_slice: int | None = None
) -> DataFrame:
    """Rows of the key so far, each time no row follows within ``idle``.

    A row exactly ``idle`` later still counts as following. The count never resets.
    """
    key_names = names(keys)
    plan = plan_slices(df, key_names, [time, *names(order_by)], rows_per_slice)
    seen = running(plan.assign(df), plan, count=position(), _next=following(F.col(time)))
    quiet = F.col("_next").isNull() | (F.col("_next.value") - F.col(time) > idle)
    return seen.filter(quiet).select(*key_names, F.col(time), "count")


def timer_echo(df: DataFrame, keys, time: str, delay: int, out: str = "fire_time") -> DataFrame:
    """One row per key and distinct time, ``delay`` later."""
    return df.select(*names(keys), (F.col(time) + delay).alias(out)).distinct()
