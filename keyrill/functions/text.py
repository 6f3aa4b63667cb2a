"""Text expressions: lines, tokens and tagged words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lines_of(text: Column) -> Column:
    """Lines of a text: split at newlines, a final newline opens no further line."""
    # Literal replacing and splitting at one character; a regular expression is slower.
    unix = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    body = F.when(unix.endswith("\n"), F.left(unix, F.length(unix) - 1)).otherwise(unix)
    return F.split(body, "\n")


def tokens_of(line: Column) -> Column:
    """Split at single spaces; empty tokens are kept except at the end of the line.

    An empty line has one empty token, a line of spaces has none.
    """
    stripped = F.rtrim(line)
    none = F.array().cast("array<string>")
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(stripped == "", none)
        .otherwise(F.split(stripped, " "))
    )


def explode_lines(df: DataFrame, text: str, line_no: str = "line_no", line: str = "line") -> DataFrame:
    """One row per line, numbered from 0; other columns are kept."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(lines_of(F.col(text))).alias(line_no, line))


def explode_tokens(df: DataFrame, line: str, pos: str = "pos", token: str = "token") -> DataFrame:
    """One row per token of a line, numbered from 0; other columns are kept."""
    rest = [c for c in df.columns if c != line]
    return df.select(*rest, F.posexplode(tokens_of(F.col(line))).alias(pos, token))


def word_variants(word: Column, prefix: str) -> Column:
    """Two tagged rows per word: a match marker, and the word with the number 1."""
    marker = F.when(word.startswith(prefix), F.lit("match")).otherwise(F.lit("no_match"))
    empty = F.lit(None).cast("string")
    return F.array(
        F.struct(marker.alias("kind"), empty.alias("word"), F.lit(None).cast("int").alias("num")),
        F.struct(F.lit("count").alias("kind"), word.alias("word"), F.lit(1).alias("num")),
    )
