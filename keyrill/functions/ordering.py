"""Key and order columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Key = str | int | Column


def names(columns: str | Sequence[str] | None) -> list[str]:
    if columns is None:
        return []
    return [columns] if isinstance(columns, str) else list(columns)


def with_keys(df: DataFrame, keys: Key | Sequence[Key] | None) -> tuple[DataFrame, list[str]]:
    """Key names for keys given by name, position or expression.

    An expression becomes a column ``key_<i>`` of the returned frame.
    """
    if keys is None:
        return df, []
    listed = list(keys) if isinstance(keys, (list, tuple)) else [keys]
    found: list[str] = []
    for i, key in enumerate(listed):
        if isinstance(key, Column):
            df = df.withColumn(f"key_{i}", key)
            found.append(f"key_{i}")
        elif isinstance(key, int):
            found.append(df.columns[key])
        else:
            found.append(key)
    return df, found


def as_number(df: DataFrame, column: str) -> Column:
    """A non-decreasing map of a number, date, time, text, binary or boolean column to double.

    Text and binary go by their first six bytes, which a double holds exactly. Null comes
    first, not-a-number last.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(value.cast("timestamp")).cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, T.NumericType):
        number = value.cast("double")
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        digits = F.substring(F.hex(value.cast("binary")), 1, 12)
        number = F.conv(F.rpad(digits, 12, "0"), 16, 10).cast("double")
    elif isinstance(kind, T.BooleanType):
        number = value.cast("int").cast("double")
    else:
        raise TypeError(f"cannot order by {column!r} of type {kind.simpleString()}")
    return F.coalesce(F.nanvl(number, F.lit(float("inf"))), F.lit(float("-inf")))


def descending(df: DataFrame, column: str) -> Column:
    """An expression whose ascending order is the descending order of ``column``."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(value)
    if isinstance(kind, T.DecimalType):
        return -value
    if isinstance(kind, T.FractionalType):
        return F.struct(~F.isnan(value), -value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.bitwise_not(F.unix_micros(value.cast("timestamp")))
    if isinstance(kind, T.DateType):
        return F.bitwise_not(F.unix_date(value))
    if isinstance(kind, T.BooleanType):
        return ~value
    if isinstance(kind, T.StringType):
        # Swapping the hex digits reverses byte order; "G" puts a prefix after its extensions.
        return F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    raise TypeError(f"cannot order by {column!r} of type {kind.simpleString()}")
