"""Mixing sources to target weights by Pfair scheduling.

The documents of each source, in a fixed pseudo-random order, are cut into blocks. With weight w a source's
block j (from 0) is released at slot floor(j / w) and due by slot ceil((j + 1) / w); in each slot the
released block that is due first goes next (ties to the larger weight, then the source's name). As weights
sum to one, every block meets its window, so after any number of slots each source has its share to less than one block.

Weights are whole numbers of a period's slots, and the schedule repeats with it. Given weights are fractions as
written (0.1 is a tenth), and their common denominator is the period, so they hold exactly, up to ``MOST_BLOCKS``. Every other
weight is rounded by largest remainder to a period of at least as many slots as the table has blocks, so rounding adds less
than one block over the whole table. A block has ``block_bytes``, or a ``MOST_BLOCKS``-th of the table if that is more, which bounds the
period. Only a source whose weight is zero, or less than one slot, is raised to one, which the others give in proportion
to what they have above one. There are never fewer than ``SLOTS_PER_SOURCE`` slots a source.

Block j of a source with ``a`` slots gets slot ``(j div a) * period`` plus the place of its block ``j mod a``. Sources of
one share have the same windows and take turns, so the layout keeps one number per distinct share, about the root of the
period at most. When a source runs out, its slots stay empty and the others go on: every document is placed once.

Only DataFrame functions are used. Sizes are summed per (source, chunk) before they are
accumulated, so a source with most of the documents is not summed by one task; rows per source are ranked by one.

Without given weights a source's weight is its bytes to the power ``temper``. A source
missing from given weights has weight zero; weights that are all zero are equal. Defined cases: a null source is a source of its own; a null text has
no bytes; rows are ordered within a chunk by doc_id, null first, and equal rows in either
order; an empty table gives no rows. Extra columns pass through, whatever their names; columns with the names of
the result's are replaced.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize, set_aside

BLOCK_BYTES = 64 << 10
MOST_BLOCKS = 1 << 16
SHORTEST = 720
SLOTS_PER_SOURCE = 8
STEPS = 256
MOST_BROADCAST = 1 << 20
TEMPER = 0.7
CHUNKS = 1024
MIXED = ["block", "release", "deadline", "slot"]


def chunk(doc_id: Column, chunks: int) -> Column:
    """A fixed pseudo-random chunk of a document, by multiplicative hashing."""
    low = F.pmod(F.coalesce(doc_id.cast("long"), F.lit(0)), F.lit(1 << 31))
    return F.floor(F.pmod(low * F.lit(2_654_435_761), F.lit(1 << 32)) * chunks / F.lit(1 << 32)).cast("long")


def given_weights(sizes: DataFrame, weights: dict[str | None, float]) -> DataFrame:
    """``sizes`` with the weight ``w`` of each source, null where none was given."""
    rows = [(source, float(value)) for source, value in weights.items()]
    given = sizes.sparkSession.createDataFrame(rows, "_name string, w double")
    return sizes.join(given, F.col("source").eqNullSafe(F.col("_name")), "left").drop("_name")


def exact_period(sizes: DataFrame, weights: dict[str | None, float]) -> int | None:
    """Slots in which the weights of the sources of ``sizes`` are whole; none if that is over ``MOST_BLOCKS`` or one is zero."""
    given = given_weights(sizes, weights)
    there = [r["source"] for r in given.filter(F.col("w").isNotNull()).select("source").collect()]  # no more than were given
    parts = [Fraction(str(weights[s])) for s in there]
    if not all(parts) or given.filter(F.col("w").isNull()).head(1):
        return None
    whole = math.lcm(*(p.denominator for p in parts))
    numbers = [int(p * whole) for p in parts]
    period = sum(numbers) // math.gcd(*numbers) if numbers else 1
    return period if period <= MOST_BLOCKS else None


def shares(sizes: DataFrame, weights: dict[str | None, float] | None, period: int, temper: float) -> DataFrame:
    """Rows (source, share): whole slots of a period in proportion to the weights, at least one each.

    ``sizes`` has a row per source with its ``bytes``. There must be no more sources than slots.
    """
    if weights is None:
        table = sizes.withColumn("w", F.pow(F.greatest(F.col("bytes"), F.lit(1)).cast("double"), F.lit(temper)))
    else:
        table = given_weights(sizes, weights).fillna({"w": 0.0})
    every = Window.partitionBy()
    total = F.sum("w").over(every)
    above = F.when(total > 0, F.greatest(F.col("w") * period / total - 1, F.lit(0.0))).otherwise(F.lit(1.0))
    weighed = table.select(
        "source", above.alias("above"), (F.lit(period) - F.count(F.lit(1)).over(every)).alias("free")
    )
    exact = F.col("above") * F.col("free") / F.greatest(F.sum("above").over(every), F.lit(1e-300))
    whole = weighed.select("source", "free", F.floor(exact).alias("base"), (exact - F.floor(exact)).alias("rest"))
    rank = F.row_number().over(Window.orderBy(F.desc("rest"), F.asc_nulls_first("source")))
    left = F.col("free") - F.sum("base").over(every)
    return whole.select("source", (1 + F.col("base") + F.when(rank <= left, 1).otherwise(0)).cast("long").alias("share"))


def layout(shared: DataFrame, period: int) -> DataFrame:
    """Rows (source, share, turn, place): the slot in a period of each of a source's blocks there."""
    classes = shared.groupBy("share").agg(F.count(F.lit(1)).alias("members")).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("o"), "share", "members"))).alias("classes")
    )

    def due(done: Column, t: Column) -> Column:
        """Index of the class whose next block is released and due first in slot t."""
        options = F.transform("classes", lambda c, i: F.get(F.transform(
            F.array(F.floor(F.get(done, i) / c["members"])),
            # released: floor(j * period / share) <= t, for j blocks of each member done
            lambda j: F.when(
                (j < c["share"]) & (F.floor(j * period / c["share"]) <= t),
                F.struct(F.ceil((j + 1) * period / c["share"]).alias("d"), i.cast("long").alias("i")),
            )
        ), F.lit(0)))
        return F.array_min(F.filter(options, lambda o: o.isNotNull()))["i"]

    def step(acc: Column, t: Column) -> Column:
        return F.get(F.transform(F.array(due(acc["done"], t)), lambda best: F.struct(
            F.transform(acc["done"], lambda n, i: F.when(i == best, n + 1).otherwise(n)).alias("done"),
            F.concat(acc["picks"], F.array(F.struct(best.alias("i"), F.get(acc["done"], best.cast("int")).alias("n")))).alias("picks"),
        )), F.lit(0))

    none = F.array().cast("array<struct<i:bigint,n:bigint>>")

    def stretch(acc: Column, first: Column) -> Column:
        """A short list of picks at a time, as a list is copied when one is added."""
        until = F.least(first + (STEPS - 1), F.lit(period - 1).cast("long"))
        start = F.struct(acc["done"].alias("done"), none.alias("picks"))
        return F.aggregate(F.sequence(first, until), start, step, lambda a: F.struct(
            a["done"].alias("done"), F.concat(acc["picks"], F.array(a["picks"])).alias("picks")
        ))

    start = F.struct(
        F.transform("classes", lambda c: F.lit(0).cast("long")).alias("done"), F.array().cast("array<array<struct<i:bigint,n:bigint>>>").alias("picks")
    )
    firsts = F.sequence(F.lit(0).cast("long"), F.lit(period - 1).cast("long"), F.lit(STEPS).cast("long"))
    picks = F.flatten(F.aggregate(firsts, start, stretch, lambda a: a["picks"]))
    slots = classes.filter(F.size("classes") > 0).select("classes", picks.alias("picks")).select(
        "classes", F.posexplode("picks").alias("place", "pick")
    ).withColumn("class", F.get("classes", F.col("pick.i").cast("int"))).select(
        F.col("class.share").alias("share"),
        F.pmod(F.col("pick.n"), F.col("class.members")).alias("member"),
        F.floor(F.col("pick.n") / F.col("class.members")).cast("long").alias("turn"),
        F.col("place").cast("long").alias("place"),
    )
    member = F.row_number().over(Window.partitionBy("share").orderBy(F.asc_nulls_first("source"))).cast("long") - 1
    return slots.join(shared.withColumn("member", member), ["share", "member"]).select("source", "share", "turn", "place")


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    block_bytes: int = BLOCK_BYTES,
    period: int | None = None,
    temper: float = TEMPER,
    chunks: int = CHUNKS,
) -> DataFrame:
    """``docs`` with ``block`` (within the source), its ``release`` and ``deadline``, and its ``slot``.

    The layout, a row per slot of a period, is broadcast up to ``MOST_BROADCAST`` rows and joined by a shuffle on
    source and turn beyond. More sources than a ``period`` that is given raise an error.
    """
    names = [c for c in docs.columns if c.lower() not in MIXED]
    held, column = set_aside(docs.select(*[F.col(f"`{c}`") for c in names]), ["doc_id", "text", "source"])
    sized = held.select(
        *held.columns,
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_bytes"),
        F.xxhash64("text").alias("_tie"),
        # A null source apart from an empty one, in columns that join and group alike.
        F.coalesce("source", F.lit("")).alias("_source"),
        F.col("source").isNull().alias("_none"),
        chunk(F.col("doc_id"), chunks).alias("_chunk"),
    )
    keys = ["_source", "_none", "_chunk"]
    counted = materialize(sized.groupBy("source", *keys).agg(F.sum("_bytes").alias("_sum")), "mixing")
    before = Window.partitionBy("_source", "_none").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    sizes = counted.groupBy("source").agg(F.sum("_sum").alias("bytes"))
    per_block = F.greatest(F.lit(block_bytes), F.ceil(F.sum("bytes").over(Window.partitionBy()) / MOST_BLOCKS)).cast("long")
    blocks = F.floor(F.col("bytes") / F.col("per_block")) + 1
    table = sizes.withColumn("per_block", per_block).agg(
        F.count(F.lit(1)).alias("n"), F.max("per_block").alias("per_block"), F.sum(blocks).alias("blocks")
    ).head()
    n, block_bytes = table["n"], table["per_block"] or block_bytes
    if period is None:
        period = exact_period(sizes, weights) if weights else None
        period = period or max(SHORTEST, SLOTS_PER_SOURCE * n, table["blocks"] or 0)
    if n > period:
        raise ValueError(f"{n} sources need a period of as many slots at least, not {period}")
    laid = layout(materialize(shares(sizes, weights, period, temper), "mixing-shares"), period)
    slots = materialize(laid, "mixing-slots")
    within = Window.partitionBy(*keys).orderBy("doc_id", "_bytes", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    scheduled = (
        sized.withColumn("_in", F.coalesce(F.sum("_bytes").over(within), F.lit(0)))
        .join(starts, keys)
        .withColumn("block", F.floor((F.col("_start") + F.col("_in")) / block_bytes).cast("long"))
    )
    if period <= MOST_BROADCAST:
        places = slots.groupBy("source", "share").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("turn", "place"))), lambda x: x["place"]).alias("_places")
        ).select(F.col("source").alias("_t"), F.col("share").alias("_share"), "_places")
        scheduled = scheduled.join(F.broadcast(places), F.col("source").eqNullSafe(F.col("_t")))
        place = F.get("_places", F.pmod("block", "_share").cast("int"))
    else:
        of_source = slots.filter("turn = 0").select(
            F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_none"), F.col("share").alias("_share")
        )
        places = slots.select(
            F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_none"), F.col("turn").alias("_turn"), "place"
        ).withColumnRenamed("place", "_place")
        # The share joins the starts, a row per source and chunk, so that a large source is dealt by its turns.
        scheduled = (
            scheduled.join(starts.join(of_source, ["_source", "_none"]).select(*keys, "_share"), keys)
            .withColumn("_turn", F.pmod("block", "_share"))
            .join(places, ["_source", "_none", "_turn"])
        )
        place = F.col("_place")
    return scheduled.select(
        *[column(c) for c in names],
        "block",
        F.floor(F.col("block") * period / F.col("_share")).cast("long").alias("release"),
        F.ceil((F.col("block") + 1) * period / F.col("_share")).cast("long").alias("deadline"),
        (F.floor(F.col("block") / F.col("_share")).cast("long") * period + place).alias("slot"),
    )


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """A row per document with its place in the mix, without texts."""
    sized = docs.select("doc_id", "source", "text")
    return mix(sized, **options).select("doc_id", "source", *MIXED)


def in_mix_order(docs: DataFrame, **options) -> DataFrame:
    """``docs`` sorted by slot, and within a slot in the order of the source."""
    held, column = set_aside(docs, ["doc_id", "text", "source"])
    placed = mix(held, **options).orderBy("slot", chunk(F.col("doc_id"), options.get("chunks", CHUNKS)), "doc_id")
    return placed.select(*[column(c) for c in docs.columns])
