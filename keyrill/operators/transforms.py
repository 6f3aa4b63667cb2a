"""Element transforms that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *positions: int) -> DataFrame:
    """Columns by position, from 0, in the order asked for."""
    return df.select(*[df.columns[i] for i in positions])


def tag_rows(df: DataFrame, out: str = "tags", **labels: Column) -> DataFrame:
    """Each row with the names of the conditions it meets."""
    marks = [F.when(test, F.lit(name)) for name, test in labels.items()]
    return df.withColumn(out, F.array_compact(F.array(*marks)))


def select_tagged(df: DataFrame, *wanted: str, tags: str = "tags") -> DataFrame:
    """Rows with any of the wanted labels, each row once."""
    return df.filter(F.arrays_overlap(F.col(tags), F.array(*[F.lit(w) for w in wanted])))


class RichFunction:
    """A per-task function: ``open`` once, ``flat_map`` per Arrow batch, ``close`` once."""

    def open(self, partition: int) -> None: ...

    def flat_map(self, batch):
        raise NotImplementedError

    def close(self) -> None: ...


def rich_flat_map(df: DataFrame, factory: Callable[[], RichFunction], schema: str) -> DataFrame:
    """Run one function object per task; each batch gives an iterable of Arrow batches."""

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        function = factory()
        function.open(TaskContext.get().partitionId())
        try:
            for batch in batches:
                yield from function.flat_map(batch)
        finally:
            function.close()

    return df.mapInArrow(run, schema)


def labelled(df: DataFrame, label: str, columns: Sequence[str], out: str = "line") -> DataFrame:
    """Printable rows: the label, ``> `` and the values in parentheses."""
    shown = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    return df.withColumn(out, F.concat(F.lit(f"{label}> ("), shown, F.lit(")")))


def stamp_arrival(df: DataFrame, out: str = "arrived") -> DataFrame:
    """Rows with their time of arrival in epoch milliseconds, for windows by the clock.

    On a stream all rows of a micro-batch arrive at the same time.
    """
    return df.withColumn(out, F.unix_millis(F.current_timestamp()))


def counted(df: DataFrame, name: str = "rows"):
    """``df`` with a row counter attached, and the counter.

    Read ``counter.get[name]`` after an action on the returned frame has ended.
    """
    from pyspark.sql import Observation

    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias(name)), counter


def fail_on(df: DataFrame, poison: Column, message: str = "poison record") -> DataFrame:
    """Fail the job at the first row that meets the condition."""
    checked = F.when(poison, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.filter(checked)


def quarantine(df: DataFrame, poison: Column, out: str = "quarantined") -> DataFrame:
    """Mark rows that meet the condition instead of failing; unknown counts as good."""
    return df.withColumn(out, F.coalesce(poison, F.lit(False)))
