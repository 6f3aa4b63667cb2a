"""Looking up rows in a changing configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.functions.ordering import names
from keyrill.plans.running import latest, running
from keyrill.plans.slices import MAX_LISTED, ROWS_PER_SLICE, hot_keys, plan_slices


def latest_config(config: DataFrame, code: str, value: str, order_by: str | Sequence[str]) -> DataFrame:
    """The last value per code."""
    return config.groupBy(code).agg(F.max_by(value, F.struct(*names(order_by))).alias(value))


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str, rows_per_key: int | None = None) -> DataFrame:
    """Inner join with a lookup that has one row per key.

    Adaptive execution broadcasts the lookup if its measured size allows, and splits the
    shuffle partition of a hot key. Where at most ``MAX_LISTED`` keys have very many facts, those
    leave the shuffle join: their lookup rows, counted, are broadcast to the facts where those lie.
    """
    found = hot_keys(facts, [on], rows_per_key or ROWS_PER_SLICE).limit(MAX_LISTED + 1).collect()
    if not found or len(found) > MAX_LISTED:
        return facts.join(lookup, on)
    is_hot = F.xxhash64(on).isin([r["h"] for r in found])
    spread = facts.filter(~is_hot).join(lookup.filter(~is_hot), on)
    placed = facts.filter(is_hot).join(F.broadcast(lookup.filter(is_hot)), on)
    return spread.unionByName(placed)


def broadcast_enrich(
    events: DataFrame, config: DataFrame, code: str, value: str, config_order, rows_per_key: int | None = None
) -> DataFrame:
    """Events with the final configuration of their code; unknown codes are dropped."""
    return lookup_join(events, latest_config(config, code, value, config_order), code, rows_per_key)


def keyed_value_text(value: Column, key: Column) -> Column:
    return F.format_string("%s,key:%s", value, key)


def enrich_as_of(
    events: DataFrame, config: DataFrame, code: str, value: str, order_by, rows_per_slice: int | None = None
) -> DataFrame:
    """Events with the configuration that arrived before them; others are dropped.

    Both inputs share the order columns; a configuration row comes before an event of
    equal order.
    """
    order = names(order_by)
    told = config.select(code, *order, F.lit(0).alias("_kind"), F.struct(F.col(value)).alias("_told"))
    asked = events.select(code, *order, F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_event"))
    both = told.unionByName(asked, allowMissingColumns=True)
    plan = plan_slices(both, [code], [*order, "_kind"], rows_per_slice)
    known = running(plan.assign(both), plan, _known=latest(F.col("_told")))
    found = known.filter((F.col("_kind") == 1) & F.col("_known").isNotNull())
    return found.select("_event.*", F.col(f"_known.{value}").alias(value))
