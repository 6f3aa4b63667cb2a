"""Operators over all rows of a stream in order, without a key that holds them all.

Rows wait in state by cell, a range of the order column, and leave when the watermark has passed the end of
their cell; so each micro-batch gets whole cells that follow those of the batches before. There the batch form of the operator
runs over its rows, which slices them if they are many. What goes from batch to batch is small and lies under the number of
the batch in the shared folder: a few counts, the rows of a window that is not full, or the numbers of the
batches that hold the open run. A batch that is run again reads the same and writes the same in the same place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.operators.count_windows import count_window_reduce
from keyrill.operators.rolling import row_index
from keyrill.operators.segments import marker_segments
from keyrill.streaming.processors import KeyedProcessor, Ordered, SHIFT_MS

CELL = "cell"
SEGMENT = "segment bigint, part bigint, size bigint, text string"


class Release(KeyedProcessor):
    """Gives the rows of a closed cell as they are."""

    def init(self, handle) -> None: ...

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from rows


class Cells(Ordered):
    """Holds the rows of a cell until the watermark has passed the whole cell."""

    def __init__(self, columns: Sequence[str], kinds: Sequence[str], time: str, per_ms: int, width: int):
        super().__init__(Release([CELL]), columns, kinds, time, per_ms)
        self.width = width

    def _rest_until(self, at: int) -> None:
        end = (at // self.width + 1) * self.width - 1
        self.handle.registerTimer(-(-end // self.per_ms) + SHIFT_MS)


def closed_cells(stream: DataFrame, order: str, width: int, delay_ms: int, per_ms: int = 1) -> DataFrame:
    """The rows of a stream, each when its cell of ``width`` values of ``order`` is closed.

    ``order`` is a whole number of ``per_ms`` units a millisecond, zero or more; ``delay_ms`` as for ``ordered_state``.
    """
    micros = F.col(order) * (1000 // per_ms) + SHIFT_MS * 1000
    celled = stream.withColumn(CELL, F.floor(F.col(order) / width).cast("long"))
    timed = celled.withColumn("_at", F.timestamp_micros(micros)).withWatermark("_at", f"{delay_ms} milliseconds")
    kinds = [f.dataType.simpleString() for f in celled.schema]
    return timed.groupBy(CELL).transformWithStateInPandas(
        statefulProcessor=Cells(celled.columns, kinds, order, per_ms, width),
        outputStructType=celled.schema, outputMode="Append", timeMode="EventTime",
    ).drop(CELL)


def _before(batch: DataFrame, folder: str, number: int, schema: str) -> dict:
    """What the batch before left, by the names of ``schema``; nothing before the first."""
    row = batch.sparkSession.read.schema(schema).parquet(f"{folder}/carry/batch={number - 1}").head() if number else None
    return row.asDict() if row else {}


def _leave(batch: DataFrame, folder: str, number: int, schema: str, *values) -> None:
    carry = batch.sparkSession.createDataFrame([values], schema)
    carry.coalesce(1).write.mode("overwrite").parquet(f"{folder}/carry/batch={number}")


def count_windows_all(
    folder: str, order_by: str, size: int, reduce: Callable[[Column, Column], Column], rows_per_slice: int | None = None
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` over ``closed_cells``: full windows of ``size`` rows to ``folder/out``, reduced in order.

    Fewer than ``size`` rows wait for the next batch.
    """

    def store(batch: DataFrame, number: int) -> None:
        done = _before(batch, folder, number, "windows long").get("windows", 0)
        if number:
            batch = batch.unionByName(batch.sparkSession.read.schema(batch.schema).parquet(f"{folder}/rest/batch={number - 1}"))
        batch.persist()
        full = batch.count() // size
        reduced = count_window_reduce(batch, None, order_by, size, reduce, rows_per_slice=rows_per_slice)
        reduced.withColumn("window_no", F.col("window_no") + done).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
        # The rows behind the last full window.
        rest = row_index(batch, order_by, out="_at", rows_per_slice=rows_per_slice).filter(F.col("_at") > full * size).select(*batch.columns)
        rest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/rest/batch={number}")
        _leave(batch, folder, number, "windows long", done + full)
        batch.unpersist()

    return store


def segments_all(
    folder: str, order_by: str, item: str, marker: str, max_items: int, rows_per_slice: int | None = None
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` over ``closed_cells``: the parts of the segments that end in a batch to ``folder/out``.

    The items of the open run stay in the folders of the batches they came in, and are read when its marker comes.
    """
    schema = "closed long, open array<long>"

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _before(batch, folder, number, schema)
        closed, waiting = before.get("closed", 0), before.get("open", [])
        batch.persist()
        is_marker = F.col(item).eqNullSafe(F.lit(marker))
        markers, last = batch.agg(F.count_if(is_marker), F.max(F.when(is_marker, F.col(order_by)))).head()
        after = batch if last is None else batch.filter(F.col(order_by) > last)
        after.write.mode("overwrite").parquet(f"{folder}/open/batch={number}")
        out = f"{folder}/out/batch={number}"
        if markers:
            rows = batch.filter(F.col(order_by) <= last)
            if waiting:
                held = spark.read.schema(batch.schema).parquet(*[f"{folder}/open/batch={n}" for n in waiting])
                rows = rows.unionByName(held)
            parts = marker_segments(rows, None, order_by, item, marker, rows_per_slice, max_items)
            parts.withColumn("segment", F.col("segment") + closed).write.mode("overwrite").parquet(out)
        else:
            spark.createDataFrame([], SEGMENT).write.mode("overwrite").parquet(out)
        _leave(batch, folder, number, schema, closed + markers, [number] if markers else [*waiting, number])
        batch.unpersist()

    return store
