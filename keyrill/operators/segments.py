"""Runs of items closed by a marker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from keyrill.functions.ordering import names, with_keys
from keyrill.operators.rolling import Keys
from keyrill.plans.running import Among, Scan, scanned, since_reset, upto, whole
from keyrill.plans.slices import plan_slices

# Items a text holds at most; every run is cut into parts of this many items.
MAX_ITEMS = 100_000


def _segment_scan(is_marker: Column) -> Scan:
    """The ``segment`` of each row, which a marker closes, the items before it there, and whether a marker comes at all."""
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")

    def local(rows: DataFrame, w: WindowSpec) -> DataFrame:
        counted = rows.withColumns({
            "_closed": F.sum(one(is_marker)).over(upto(w)), "_items": F.sum(one(~is_marker)).over(upto(w)),
            "_markers": F.sum(one(is_marker)).over(whole(w)),
        })
        based = counted.withColumn("_base", F.last(F.when(is_marker, F.col("_items")), ignorenulls=True).over(upto(w)))
        return based.withColumns({
            "segment": F.col("_closed") - one(is_marker), "_since": F.col("_items") - F.coalesce("_base", F.lit(0)),
        }).withColumns({
            # A marker comes if not all of them came before; a frame from the row to the end would be gone over for each row.
            "_within": F.col("_since") - 1, "_ends": F.col("segment") < F.col("_markers"),
        }).drop("_items", "_base", "_markers")

    def summary(order: Column) -> dict[str, Column]:
        return {"_markers": F.max("_closed"), "_tail": F.max_by("_since", order)}

    def carry(summaries: DataFrame, among: Among) -> DataFrame:
        placed = summaries.withColumns({
            "_c_closed": F.sum("_markers").over(among.before),
            "_c_ends": F.sum("_markers").over(upto(among.in_order)) < F.sum("_markers").over(whole(among.in_order)),
        })
        return since_reset(placed, among, F.col("_markers") > 0, _c_open=F.col("_tail"))

    def finish(rows: DataFrame) -> DataFrame:
        # Before the first marker of a slice the run of the slices before goes on.
        first = F.col("segment") == 0
        return rows.withColumns({
            "_within": F.col("_within") + F.when(first, F.coalesce("_c_open", F.lit(0))).otherwise(0),
            "_ends": F.col("_ends") | F.coalesce("_c_ends", F.lit(False)),
            "segment": F.col("segment") + F.coalesce("_c_closed", F.lit(0)),
        })

    return Scan(local, summary, carry, ["_c_closed", "_c_ends", "_c_open"], finish)


def marker_segments(
    df: DataFrame,
    keys: Keys,
    order_by,
    item: str,
    marker: str,
    rows_per_slice: int | None = None,
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Size and text of each run of items before a marker; an unclosed tail gives nothing.

    Every item of the text follows a space. A run comes in parts of ``max_items`` items, the
    last one shorter, numbered from 0: a row each, whose texts joined in order are the run's.
    """
    df, key_names = with_keys(df, keys)
    order = names(order_by)
    is_marker = F.col(item).eqNullSafe(F.lit(marker))
    plan = plan_slices(df, key_names, order, rows_per_slice)
    numbered = scanned(plan.assign(df), plan, _segment_scan(is_marker))
    run = [*key_names, "segment"]
    entry = F.struct(*[F.col(o).alias(f"order_{i}") for i, o in enumerate(order)], F.coalesce(item, F.lit("null")).alias("item"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat(F.lit(" "), e["item"])), "")
    parts = (
        numbered.filter(~is_marker & F.col("_ends")).withColumn("part", F.floor(F.col("_within") / max_items).cast("long"))
        .groupBy(*run, "part").agg(F.count(F.lit(1)).alias("size"), text.alias("text"))
    )
    return parts.select(*run, "part", "size", "text")
