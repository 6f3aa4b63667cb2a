"""Running values over the rows of a key in order, with hot keys split.

An operator gives a ``Scan``: what it computes inside a slice by windows, a summary of a slice, what the slices
before (or after) contribute to it, worked out by windows over the summaries, and how both go together. Where no key is hot only
the first part runs. Else the rows with their values inside slices are written once, in the order of the
windows; one aggregate over them gives all summaries of an operator, and one join brings all it carries back.
The table of what is carried has a row per (hot key, slice), is written too, and is broadcast up to ``MAX_CARRY_ROWS`` of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from keyrill.plans.slices import MAX_CARRY_ROWS, SLICE, SlicePlan, is_hot
from keyrill.plans.stored import stored


def upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


@dataclass(frozen=True)
class Among:
    """Windows over the summaries of the slices of a key."""

    keys: list
    in_order: WindowSpec
    before: WindowSpec
    after: WindowSpec


@dataclass(frozen=True)
class Scan:
    """``local(rows, window)`` inside slices; ``summary(order)`` per slice; ``carry(summaries, among)`` adds the
    columns named ``carried``; ``finish(rows)`` merges them, and is left out where nothing is carried."""

    local: Callable[[DataFrame, WindowSpec], DataFrame]
    summary: Callable[[Column], dict[str, Column]]
    carry: Callable[[DataFrame, Among], DataFrame]
    carried: list[str]
    finish: Callable[[DataFrame], DataFrame]


def scanned(df: DataFrame, plan: SlicePlan, scan: Scan) -> DataFrame:
    """``df`` (already assigned to slices) with the values of a scan."""
    order = F.struct(*plan.order_by)
    rows = scan.local(df, Window.partitionBy(*plan.partition_keys).orderBy(*plan.order_by))
    if not plan.sliced:
        return rows
    rows = stored(rows, "slices")
    summaries = rows.filter(is_hot()).groupBy(*plan.partition_keys).agg(*[c.alias(n) for n, c in scan.summary(order).items()])
    by_key = Window.partitionBy(*(plan.keys or [F.lit(0)]))
    among = Among(
        plan.keys,
        by_key.orderBy(F.col(SLICE)),
        by_key.orderBy(F.col(SLICE)).rowsBetween(Window.unboundedPreceding, -1),
        by_key.orderBy(F.col(SLICE)).rowsBetween(1, Window.unboundedFollowing),
    )
    keys = [F.col(k).alias(f"_k_{k}") for k in plan.partition_keys]
    carry = stored(scan.carry(summaries, among).select(*keys, *scan.carried), "carries")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in plan.keys] + [F.col(SLICE) == F.col(f"_k_{SLICE}")]
    joined = rows.join(F.broadcast(carry) if plan.pairs <= MAX_CARRY_ROWS else carry, same, "left")
    return scan.finish(joined).drop(*carry.columns)


@dataclass(frozen=True)
class Running:
    """A running value of its own: inside a slice, per slice, across slices, and both together."""

    local: Callable[[WindowSpec, Column], Column]
    partial: Callable[[Column], Column]
    fold: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]
    following: bool = False


def _add(local: Column, carry: Column) -> Column:
    return F.coalesce(local + carry, local, carry)


def _first_known(local: Column, carry: Column) -> Column:
    return F.coalesce(local, carry)


def total(value: Column) -> Running:
    """Sum up to and including the row."""
    return Running(lambda w, o: F.sum(value).over(upto(w)), lambda o: F.sum(value), F.sum, _add)


def position() -> Running:
    """Number of the row within its key, from 1."""
    return Running(
        lambda w, o: F.row_number().over(w).cast("long"), lambda o: F.count(F.lit(1)), F.sum, _add
    )


def smallest(value: Column) -> Running:
    """Smallest value up to and including the row."""
    return Running(lambda w, o: F.min(value).over(upto(w)), lambda o: F.min(value), F.min, F.least)


def latest(value: Column) -> Running:
    """Last value that is not null, up to and including the row."""
    return Running(
        lambda w, o: F.last(value, ignorenulls=True).over(upto(w)),
        lambda o: F.max_by(value, F.when(value.isNotNull(), o)),
        lambda c: F.last(c, ignorenulls=True),
        _first_known,
    )


def previous(value: Column) -> Running:
    """The value in the row before, wrapped in a struct; null only for the first row."""
    boxed = F.struct(value.alias("value"))
    return Running(
        lambda w, o: F.lag(boxed).over(w),
        lambda o: F.max_by(boxed, o),
        lambda c: F.last(c, ignorenulls=True),
        _first_known,
    )


def following(value: Column) -> Running:
    """The value in the row after, wrapped in a struct; null only for the last row."""
    boxed = F.struct(value.alias("value"))
    return Running(
        lambda w, o: F.lead(boxed).over(w),
        lambda o: F.min_by(boxed, o),
        lambda c: F.first(c, ignorenulls=True),
        _first_known,
        following=True,
    )


def scan_of(order_by: list[str], values: dict[str, Running]) -> Scan:
    """Independent running values as one scan."""
    order = F.struct(*order_by)

    def local(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({name: v.local(w, order) for name, v in values.items()})

    def carry(summaries: DataFrame, among: Among) -> DataFrame:
        return summaries.withColumns({
            f"_c_{name}": v.fold(F.col(f"_p_{name}")).over(among.after if v.following else among.before) for name, v in values.items()
        })

    return Scan(
        local,
        lambda o: {f"_p_{name}": v.partial(o) for name, v in values.items()},
        carry,
        [f"_c_{name}" for name in values],
        lambda rows: rows.withColumns({name: v.merge(F.col(name), F.col(f"_c_{name}")) for name, v in values.items()}),
    )


def running(df: DataFrame, plan: SlicePlan, **values: Running) -> DataFrame:
    """``df`` (already assigned to slices) with one column per running value."""
    return scanned(df, plan, scan_of(plan.order_by, values))


def since_reset(summaries: DataFrame, among: Among, reset: Column, **amounts: Column) -> DataFrame:
    """Per slice the sums of ``amounts`` of the slices before it, back to and including the last one with ``reset``."""
    marked = summaries.withColumn("_era", F.sum(F.when(reset, 1).otherwise(0)).over(upto(among.in_order)))
    within = upto(Window.partitionBy(*among.keys, "_era").orderBy(SLICE))
    summed = marked.withColumns({f"_s_{name}": F.sum(value).over(within) for name, value in amounts.items()})
    return summed.withColumns({name: F.lag(f"_s_{name}").over(among.in_order) for name in amounts})
