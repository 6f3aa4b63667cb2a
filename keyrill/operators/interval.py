"""Interval join: equal keys and a bounded distance in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from keyrill.functions.ordering import names


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys,
    left_time: str,
    right_time: str,
    lower: int,
    upper: int,
    inclusive: bool = True,
) -> DataFrame:
    """Pairs with ``left_time + lower <= right_time <= left_time + upper`` (or ``<`` when exclusive).

    Times are numbers in the unit of the bounds, or timestamps with bounds in
    milliseconds; other column names must differ between the sides. Time is cut into
    cells as wide as the interval and the cell joins the keys, so a row meets at most
    the rows of its own neighbourhood and a hot key is spread over its cells. Each right
    row lies in one cell, so no pair comes twice. Works on batch and on streaming
    frames; on a stream give timestamps with watermarks, so that old state is dropped.
    """
    key_names = names(keys)
    width = max(upper - lower, 1)
    stamped = isinstance(left.schema[left_time].dataType, TimestampType)

    def cell(time: Column) -> Column:
        return F.floor((F.unix_millis(time) if stamped else time) / width)

    def shifted(by: int) -> Column:
        step = F.expr(f"interval {by / 1000:.3f} seconds") if stamped else F.lit(by)
        return F.col(left_time) + step

    first, last = shifted(lower), shifted(upper)
    spread = left.withColumn("_cell", F.explode(F.sequence(cell(first), cell(last))))
    spread = spread.withColumnsRenamed({k: f"_l_{k}" for k in key_names})
    placed = right.withColumn("_at", cell(F.col(right_time)))
    near = [F.col(f"_l_{k}") == F.col(k) for k in key_names] + [F.col("_cell") == F.col("_at")]
    if inclusive:
        near += [F.col(right_time) >= first, F.col(right_time) <= last]
    else:
        near += [F.col(right_time) > first, F.col(right_time) < last]
    joined = spread.join(placed, near)
    return joined.drop("_cell", "_at", *[f"_l_{k}" for k in key_names])
