"""Running counts over the items of lists.

A row has lists, and each list has items; items follow each other by row key, list and place. Totals are run over
lists, as many rows as there are lists, and a list becomes a row per item only at the end, in its own task and without a sort. Rows of
equal key have their items interleaved by place, which takes a window over the items of these rows alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.operators.rolling import rolling
from keyrill.plans.running import position, total
from keyrill.plans.slices import hot_keys
from keyrill.plans.stored import stored

# Items that a task gives, about.
ITEMS_PER_TASK = 1 << 22


def _spread(df: DataFrame) -> DataFrame:
    """``df`` dealt anew if its files feed fewer tasks than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    fed = df.select(F.spark_partition_id().alias("p")).distinct().count()
    return df if fed >= cores else df.repartition(2 * cores, *df.columns)


def _opened(lists: DataFrame) -> DataFrame:
    """A row per item: its place ``pos``, the items up to it that meet the test (``_k``) and the last of these (``_from``, if any)."""
    kept = [c for c in lists.columns if c not in ("_n", "_where")]
    ends = lists.withColumns({"_from": F.concat(F.array(F.lit(0)), "_where"), "_to": F.concat("_where", F.array("_n"))})
    runs = ends.select(*kept, F.posexplode(F.arrays_zip("_from", "_to")).alias("_k", "_run")).filter("_run._from < _run._to")
    places = F.sequence(F.col("_run._from"), F.col("_run._to") - 1)
    return runs.select(*kept, "_k", F.col("_run._from").alias("_from"), F.explode(places).alias("pos"))


def running_item_counts(
    df: DataFrame,
    key: str,
    lists: Column,
    items: Callable[[Column], Column],
    test: Callable[[Column], Column],
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Rows (key, list_no, pos, matches, others): how many items up to each one meet ``test``, and how many do not.

    ``lists`` is an array in a row of ``df``, ``items`` makes an array of one of its elements; numbers are from 0. A null array has none.
    """
    parts = _spread(df).select(key, F.posexplode(lists).alias("list_no", "_list")).select(key, "list_no", items(F.col("_list")).alias("_items"))
    at = F.array_compact(F.transform("_items", lambda item, i: F.when(test(item), i)))
    held = stored(parts.select(key, "list_no", F.size("_items").alias("_n"), at.alias("_where")).filter("_n > 0"), "lists")
    repeated = stored(hot_keys(df, [key], 1), "repeated-keys").select(F.col("h").alias("_h"))
    some = bool(repeated.head(1))

    single, place = held, [key, "list_no"]
    counted = [F.col("_n").cast("long").alias("_all"), F.size("_where").cast("long").alias("_hits")]
    if some:
        is_repeated = F.xxhash64(key) == F.col("_h")
        single, several = held.join(repeated, is_repeated, "left_anti"), held.join(repeated, is_repeated, "left_semi")
    rows = single.select(*place, "_n", "_where", *counted)
    if some:
        merged = several.select(*place, *counted).groupBy(*place).agg(F.sum("_all").alias("_all"), F.sum("_hits").alias("_hits"))
        rows = rows.unionByName(merged, allowMissingColumns=True)
    totals = rolling(rows, None, place, rows_per_slice, _matches=total(F.col("_hits")), _seen=total(F.col("_all")))
    before = totals.select(*place, "_n", "_where", (F.col("_matches") - F.col("_hits")).alias("_m"), (F.col("_seen") - F.col("_all")).alias("_s"))

    n = held.agg(F.sum("_n")).head()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // ITEMS_PER_TASK))
    opened = _opened(before.filter(F.col("_where").isNotNull()).repartition(tasks, *place))
    counts = opened.select(*place, "pos", (F.col("_m") + F.col("_k")).alias("_m"), (F.col("_s") + F.col("pos") + 1).alias("_s"))
    if some:
        hit = ((F.col("_k") > 0) & (F.col("pos") == F.col("_from"))).cast("long")
        inside = rolling(_opened(several).withColumn("_hit", hit), place, "pos", rows_per_slice, _matches=total(F.col("_hit")), _seen=position())
        bases = before.filter(F.col("_where").isNull()).select(F.col(key).alias("_key"), F.col("list_no").alias("_list"), "_m", "_s")
        based = inside.join(bases, F.col(key).eqNullSafe(F.col("_key")) & (F.col("list_no") == F.col("_list")))
        counts = counts.unionByName(based.select(*place, "pos", (F.col("_m") + F.col("_matches")).alias("_m"), (F.col("_s") + F.col("_seen")).alias("_s")))
    return counts.select(*place, "pos", F.col("_m").alias("matches"), (F.col("_s") - F.col("_m")).alias("others"))
