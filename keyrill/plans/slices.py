"""Splitting hot keys into ordered slices.

Rolling operators need the rows of a key in order, which on its own puts a key on
one task. A key with more rows than a task should hold is split by its order columns into slices; cold
keys stay whole.

Bounds are found per hot key and level, and kept as tables in the shared folder, one row per cell that is cut: at level 0 a
cell is a hot key, at the next ones a slice of the level before that still holds too many rows. A cell is cut into at most
``FAN`` slices by quantiles of one order column, so there are as many levels as it takes and no bound on the slices of a key.
The quantiles come from mergeable sketches: of each task and cell first, then of groups of tasks, then of the cell, so
that no reducer merges the sketches of all tasks. A value that fills more than a slice alone has a slice of its own, which the next level
cuts on the next order column. A slice is a struct of its numbers at each level, which sorts in the order of the rows.

Rows are placed by joining the tables of bounds, broadcast up to ``MAX_BOUNDS`` bounds, else spread over
``SALTS`` copies of a bounds row, and a binary search in the bounds of the cell. The plan depends on nothing but tables
written once, so a lost executor recomputes the same slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.functions.ordering import as_number, names
from keyrill.plans.stored import stored

SLICE = "_slice"

ROWS_PER_SLICE = 1_000_000
MAX_LISTED = 4096
# Slices that a cell is cut into at once, a power of two, and the size of a sketch.
FAN = 256
SKETCH = 4096
SKETCH_GROUPS = 256
# Most bounds that are broadcast, and the copies of a bounds row beyond.
MAX_BOUNDS = 1 << 20
SALTS = 64
# Most (hot key, slice) pairs whose carry table is broadcast.
MAX_CARRY_ROWS = 1 << 20


def hot_keys(df: DataFrame, keys: Sequence[str], above: int = ROWS_PER_SLICE) -> DataFrame:
    """Hash and row count (h, n) of the keys with more than ``above`` rows.

    Counting combines on the map side, so a hot key crosses the shuffle as one row per task.
    """
    counted = df.groupBy(_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > above)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("long")


@dataclass(frozen=True)
class Level:
    """A row per cell that is cut: its place (h, l0, ...), order column, bounds, and which of them fill more than a slice."""

    table: DataFrame
    cells: int
    bounds: int


@dataclass(frozen=True)
class SlicePlan:
    keys: list[str]
    order_by: list[str]
    levels: list[Level] = field(default_factory=list)

    @property
    def sliced(self) -> bool:
        return bool(self.levels)

    @property
    def partition_keys(self) -> list[str]:
        return [*self.keys, SLICE] if self.sliced else self.keys

    @property
    def pairs(self) -> int:
        """At most so many (hot key, slice) pairs."""
        return sum(2 * level.bounds + level.cells for level in self.levels)

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with its slice: all numbers -1 for cold keys, rising in order for hot ones."""
        if not self.sliced:
            return df
        placed = df.withColumns({"_h": _hash(self.keys), **{f"_o{i}": as_number(df, c) for i, c in enumerate(self.order_by)}})
        for i, level in enumerate(self.levels):
            placed = _place(placed, level, i, len(self.order_by))
        numbers = F.struct(*[F.col(f"_l{i}").alias(f"l{i}") for i in range(len(self.levels))])
        return placed.withColumn(SLICE, numbers).select(*df.columns, SLICE)


def is_hot() -> Column:
    """Whether a placed row is of a hot key."""
    return F.col(f"{SLICE}.l0") >= 0


def _joined(rows: DataFrame, table: DataFrame, level: int, size: int, how: str) -> DataFrame:
    """``rows`` (_h, _l0, ..., order numbers) with the columns of the cell they are in."""
    place = ["_h", *[f"_l{i}" for i in range(level)]]
    if size <= MAX_BOUNDS:
        return rows.join(F.broadcast(table), place, how)
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in rows.columns if c.startswith("_o")]), F.lit(SALTS)).cast("int"))
    return salted.join(spread, [*place, "_salt"], how).drop("_salt")


def _value(columns: int) -> Column:
    """The order number that the cell of a row is cut on."""
    value = F.col("_o0")
    for i in range(1, columns):
        value = F.when(F.col("_column") == i, F.col(f"_o{i}")).otherwise(value)
    return value


def _place(rows: DataFrame, level: Level, number: int, columns: int, *keep: str) -> DataFrame:
    """``rows`` with their number ``_l{number}`` in the cells of a level, -1 outside of them."""
    placed = _joined(rows, level.table, number, level.bounds, "left").withColumn("_v", _value(columns))
    steps = F.array(*[F.lit(FAN >> i) for i in range(1, FAN.bit_length())])
    # How many bounds are not above the value.
    found = F.reduce(steps, F.lit(0), lambda at, step: F.when(F.get("_bounds", at + step - 1) <= F.col("_v"), at + step).otherwise(at))
    placed = placed.withColumn("_at", F.when(F.col("_bounds").isNotNull(), F.least(found, "_n_bounds")))
    last = F.col("_at")
    alone = F.coalesce((F.get("_bounds", last - 1) == F.col("_v")) & F.get("_heavy", last - 1), F.lit(False))
    slice_no = F.coalesce(2 * last - F.when((last > 0) & alone, 1).otherwise(0), F.lit(-1))
    return placed.select(*rows.columns, *keep, slice_no.cast("int").alias(f"_l{number}"))


def _cut(within: DataFrame, place: list[str], per_slice: int) -> DataFrame:
    """Bounds of about equal depth of each cell in ``within`` (place, _column, n, _v)."""
    keys = [*place, "_column", "n"]
    sketched = within.groupBy(*keys, (F.spark_partition_id() % SKETCH_GROUPS).alias("_group")).agg(
        F.kll_sketch_agg_double("_v", F.lit(SKETCH)).alias("s")
    )
    merged = sketched.groupBy(*keys).agg(F.kll_merge_agg_double("s", F.lit(SKETCH)).alias("s"))
    grid = F.expr(f"array({', '.join(f'{i / FAN}D' for i in range(1, FAN))})")
    parts = F.least(F.lit(FAN), F.ceil(F.col("n") / per_slice)).cast("int")
    chosen = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("q", F.floor(i * FAN / F.col("parts")).cast("int") - 1))
    cut = merged.select(*keys, parts.alias("parts"), F.kll_sketch_get_quantile_double("s", grid).alias("q")).withColumn("chosen", chosen)
    bounds = F.array_sort(F.array_distinct("chosen"))
    counted = cut.withColumn("known", bounds).withColumn(
        "_heavy", F.transform("known", lambda b: F.size(F.filter("chosen", lambda c: c == b)) > 1)
    )
    room = F.array_repeat(F.lit(float("inf")), FAN - 1 - F.size("known"))
    return counted.select(
        *place, "_column", F.concat("known", room).alias("_bounds"), "_heavy", F.size("known").alias("_n_bounds")
    )


def plan_slices(
    df: DataFrame,
    keys: str | Sequence[str] | None,
    order_by: str | Sequence[str],
    rows_per_slice: int | None = None,
) -> SlicePlan:
    """Find hot keys and slice bounds for ``df``.

    Without keys the whole frame is one hot key. A slice has at most twice ``rows_per_slice`` rows (a million by default)
    unless more rows than that are equal in all order columns; those stay together.
    """
    per_slice = rows_per_slice or ROWS_PER_SLICE
    key_names, order_names = names(keys), names(order_by)
    # The only wide thing a cold table costs is this count.
    hot = stored(hot_keys(df, key_names, per_slice), "hot-keys")
    cells = hot.select(F.col("h").alias("_h"), F.lit(0).alias("_column"), "n")
    size = cells.count()
    if not size:
        return SlicePlan(key_names, order_names)

    rows = df.select(_hash(key_names).alias("_h"), *[as_number(df, c).alias(f"_o{i}") for i, c in enumerate(order_names)])
    levels: list[Level] = []
    while size:
        at = len(levels)
        place = ["_h", *[f"_l{i}" for i in range(at)]]
        within = _joined(rows, cells, at, size, "inner")
        table = stored(_cut(within.withColumn("_v", _value(len(order_names))), place, per_slice), "slice-bounds")
        level = Level(table, size, table.agg(F.sum("_n_bounds")).head()[0])
        levels.append(level)
        rows = _place(rows, level, at, len(order_names))
        # Slices that are too large still; those of one value go on with the next order column.
        inside = _place(within.drop("_column", "n"), level, at, len(order_names), "_column")
        counted = inside.groupBy(*place, f"_l{at}", "_column").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * per_slice)
        following = counted.withColumn("_column", F.col("_column") + F.col(f"_l{at}") % 2).filter(F.col("_column") < len(order_names))
        cells = stored(following, "slice-cells")
        size = cells.count()
    return SlicePlan(key_names, order_names, levels)
