"""Keyed state operators on streams.

Run through ``ordered_state``, a processor gets the rows of a key in order across
micro-batches: they wait in state until the watermark has passed them. Run through
``keyed_state`` it gets them as they come, in order within a micro-batch only.
A key's waiting rows are in memory at once when they are used.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyrill.functions.ordering import names


def in_order(rows: Iterator[pd.DataFrame], order_by: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(order_by), kind="stable", ignore_index=True)


class KeyedProcessor(StatefulProcessor):
    """Base of processors that keep one value per key and name their key columns."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def keyed(self, key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        for i, name in enumerate(self.keys):
            if name not in frame.columns:
                frame.insert(i, name, [key[i]] * len(frame))
        return frame

    def advance(self, key: tuple, watermark: int) -> Iterator[pd.DataFrame]:
        """What follows from event time reaching ``watermark`` without further rows."""
        return iter(())

    def wake(self) -> int | None:
        """The event time in milliseconds at which ``advance`` has something to do."""
        return None

    def close(self) -> None: ...


# The first watermark is the epoch, and rows at or before it count as late; so times are moved on.
SHIFT_MS = 86_400_000


class Ordered(StatefulProcessor):
    """Holds rows until the watermark passes them, then gives them to a processor in order.

    ``time`` is a whole number of ``per_ms`` units a millisecond. One timer per key is kept:
    at the last waiting row, else where the processor wants to wake.
    """

    def __init__(self, inner: KeyedProcessor, columns: Sequence[str], kinds: Sequence[str], time: str, per_ms: int):
        self.inner, self.columns, self.kinds = inner, list(columns), list(kinds)
        self.time, self.per_ms = time, per_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("buffered", ", ".join(f"`{c}` {k}" for c, k in zip(self.columns, self.kinds, strict=True)))
        self.inner.init(handle)

    def _tuples(self, frame: pd.DataFrame) -> list[tuple]:
        """Rows as the state takes them: null as None, and whole numbers as such beside nulls."""
        columns = []
        for name, kind in zip(self.columns, self.kinds, strict=True):
            values = frame[name].tolist()
            whole = kind in ("bigint", "int", "smallint", "tinyint")
            columns.append([None if v is None or v != v else int(v) if whole else v for v in values])
        return list(zip(*columns, strict=True))

    def _rest_until(self, at: int) -> None:
        self.handle.registerTimer(-(-at // self.per_ms) + SHIFT_MS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        self.waiting.appendList(self._tuples(frame))
        if not list(self.handle.listTimers()):
            self._rest_until(int(frame[self.time].max()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() - SHIFT_MS
        held = pd.DataFrame([tuple(r) for r in self.waiting.get()], columns=self.columns)
        late = held[self.time] > watermark * self.per_ms
        due, rest = held[~late], held[late]
        if len(due):
            yield from self.inner.handleInputRows(key, iter([due.reset_index(drop=True)]), timerValues)
        yield from self.inner.advance(key, watermark)
        if len(rest):
            self.waiting.put(self._tuples(rest))
            self._rest_until(int(rest[self.time].max()))
        else:
            self.waiting.clear()
            at = self.inner.wake()
            if at is not None:
                self.handle.registerTimer(at + SHIFT_MS)

    def close(self) -> None:
        self.inner.close()


class RunningSum(KeyedProcessor):
    def __init__(self, keys, order_by, value: str, out: str):
        super().__init__(keys)
        self.order_by, self.value, self.out = list(order_by), value, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sum = handle.getValueState("sum", "sum bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, self.order_by)
        known = self.sum.exists()
        values = frame[self.value]
        sums = (self.sum.get()[0] if known else 0) + values.fillna(0).astype("int64").cumsum()
        seen = values.notna().cummax() | known  # null until the first value
        if seen.iloc[-1]:
            self.sum.update((int(sums.iloc[-1]),))
        yield frame.assign(**{self.out: sums.astype("Int64").where(seen)})


class RunningMaxBy(KeyedProcessor):
    """The row of the largest value so far; the first of equals stays."""

    def __init__(self, keys, order_by, value: str, fields: Sequence[str], fields_schema: str):
        super().__init__(keys)
        self.order_by, self.value, self.fields = list(order_by), value, list(fields)
        self.fields_schema = fields_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.fields_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, self.order_by)
        fields = frame[self.fields]
        if self.best.exists():
            held = pd.DataFrame([self.best.get()], columns=self.fields)
            fields = pd.concat([held, fields], ignore_index=True)
        values = pd.to_numeric(fields[self.value]).astype("float64").fillna(-np.inf)
        grew = values > values.cummax().shift(fill_value=values.iloc[0])
        at = pd.Series(np.where(grew, np.arange(len(fields)), 0)).cummax()
        best = fields.iloc[at].reset_index(drop=True)
        self.best.update(tuple(None if v != v else v.item() if hasattr(v, "item") else v for v in best.astype(object).iloc[-1]))
        shown = best.tail(len(frame)).reset_index(drop=True).add_prefix("max_")
        yield self.keyed(key, pd.concat([frame[self.order_by], shown], axis=1))


class CountWindow(KeyedProcessor):
    """Full windows: names joined in order and numbers summed; the rest waits in state."""

    def __init__(self, keys, order_by, size: int, name: str, number: str):
        super().__init__(keys)
        self.order_by, self.size, self.name, self.number = list(order_by), size, name, number

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", "name string, number bigint")
        self.done = handle.getValueState("done", "windows bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, self.order_by)
        held = list(self.waiting.get()) + list(zip(frame[self.name], frame[self.number].astype(int)))
        windows = self.done.get()[0] if self.done.exists() else 0
        full = len(held) // self.size
        rest = held[full * self.size :]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        if not full:
            return
        self.done.update((windows + full,))
        taken = pd.DataFrame(held[: full * self.size], columns=["names", "total"])
        number = pd.Series(np.arange(len(taken)) // self.size + windows, name="window_no")
        yield self.keyed(key, taken.groupby(number).agg({"names": "".join, "total": "sum"}).reset_index())


class IdleTimeout(KeyedProcessor):
    """Rows of the key so far, each time ``idle`` milliseconds pass without a row.

    For ``ordered_state``: a row after a gap reports the gap, and where no row follows the
    watermark does. The count goes on after a report.
    """

    def __init__(self, keys, time: str, idle: int):
        super().__init__(keys)
        self.time, self.idle = time, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "count bigint, last bigint")

    def report(self, key, times, counts) -> pd.DataFrame:
        return self.keyed(key, pd.DataFrame({self.time: times, "count": counts}))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = in_order(rows, [self.time])[self.time].to_numpy("int64")
        count, last = self.state.get() if self.state.exists() else (0, None)
        counts = count + np.arange(1, len(times) + 1)
        ends = np.flatnonzero(np.diff(times) > self.idle)
        reported, sizes = times[ends], counts[ends]
        if last is not None and times[0] - last > self.idle:
            reported, sizes = np.insert(reported, 0, last), np.insert(sizes, 0, count)
        self.state.update((int(counts[-1]), int(times[-1])))
        if len(reported):
            yield self.report(key, reported, sizes)

    def advance(self, key, watermark) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        count, last = self.state.get()
        if last is not None and last + self.idle <= watermark:
            self.state.update((count, None))
            yield self.report(key, [last], [count])

    def wake(self) -> int | None:
        last = self.state.get()[1] if self.state.exists() else None
        return None if last is None else last + self.idle


class MarkerSegments(KeyedProcessor):
    """Size and text of the items before each marker, in parts of at most ``max_items``.

    Full parts are not held: of an open run, the items of its unfinished part wait in list state
    and its finished parts as texts, until the marker closes the run.
    """

    def __init__(self, keys, order_by, item: str, marker: str, max_items: int):
        super().__init__(keys)
        self.order_by, self.item, self.marker, self.max_items = list(order_by), item, marker, max_items

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", "item string")
        self.parts = handle.getListState("parts", "text string")
        self.closed = handle.getValueState("closed", "segments bigint")

    def _text(self, items) -> str:
        return "".join(f" {'null' if i is None or i != i else i}" for i in items)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        items = in_order(rows, self.order_by)[self.item].to_numpy(object)
        segment = self.closed.get()[0] if self.closed.exists() else 0
        n = self.max_items
        ends = np.flatnonzero(items == self.marker)
        finished = [p[0] for p in self.parts.get()]
        run = [held[0] for held in self.open.get()]
        found, begin = [], 0
        for end in [*ends, len(items)]:
            run += list(items[begin:end])
            while len(run) >= n:
                finished.append(self._text(run[:n]))
                run = run[n:]
            if end < len(items):
                found += [(segment, part, n, text) for part, text in enumerate(finished)]
                if run:
                    found.append((segment, len(finished), len(run), self._text(run)))
                finished, run, segment, begin = [], [], segment + 1, end + 1
        if len(ends):
            self.closed.update((segment,))
        for state, held in ((self.parts, finished), (self.open, run)):
            if held:
                state.put([(h,) for h in held])
            else:
                state.clear()
        if found:
            yield self.keyed(key, pd.DataFrame(found, columns=["segment", "part", "size", "text"]))


class LastValue(KeyedProcessor):
    """Rows passed through with the value the key held before.

    A held value expires ``expires`` milliseconds of the ``time`` column after it was
    written, or, with ``ttl_ms``, that long by the clock; an expired value is never seen.
    """

    def __init__(
        self, keys, order_by, value: str, value_type: str, ttl_ms: int | None, out: str,
        time: str | None = None, expires: int | None = None,
    ):
        super().__init__(keys)
        self.order_by, self.value, self.value_type = list(order_by), value, value_type
        self.ttl_ms, self.out, self.time, self.expires = ttl_ms, out, time, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", f"value {self.value_type}, at bigint", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, self.order_by)
        values = frame[self.value].astype(object)
        before = values.shift()
        held, at = self.held.get() if self.held.exists() else (None, None)
        before.iloc[0] = held
        if self.expires is not None:
            since = frame[self.time].astype("float64").diff()
            since.iloc[0] = float(frame[self.time].iloc[0]) - at if at is not None else 0.0
            before = before.where(since <= self.expires, None)
        newest = values.iloc[-1]
        written = int(frame[self.time].iloc[-1]) if self.time else 0
        self.held.clear()
        self.held.update((newest.item() if hasattr(newest, "item") else newest, written))
        yield frame.assign(**{self.out: before})


class AsOfEnrich(KeyedProcessor):
    """Events with the value their code was last told; others are dropped.

    Rows carry ``told`` (a value, for configuration rows) and ``is_event``.
    """

    def __init__(self, keys, order_by, fields: Sequence[str], out: str):
        super().__init__(keys)
        self.order_by, self.fields, self.out = list(order_by), list(fields), out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "value string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, [*self.order_by, "is_event"])
        told = frame["told"].astype(object).where(~frame["is_event"], None)
        if self.known.exists():
            told = pd.concat([pd.Series([self.known.get()[0]], dtype=object), told], ignore_index=True)
            value = told.ffill().iloc[1:].reset_index(drop=True)
        else:
            value = told.ffill()
        newest = value.iloc[-1]
        if newest is not None and newest == newest:
            self.known.update((newest,))
        found = frame.assign(**{self.out: value})[frame["is_event"] & value.notna()]
        if len(found):
            yield found[[*self.keys, *self.order_by, *self.fields, self.out]]


def keyed_state(
    stream: DataFrame, keys, processor: StatefulProcessor, schema: str, event_time: bool = False
) -> DataFrame:
    """Run a processor per key of a stream."""
    return stream.groupBy(*names(keys)).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime" if event_time else "ProcessingTime" if _uses_ttl(processor) else "None",
    )


def ordered_state(
    stream: DataFrame, keys, processor: KeyedProcessor, schema: str, time: str, delay_ms: int, per_ms: int = 1,
    progress: Column | None = None,
) -> DataFrame:
    """Run a processor per key, in the order of ``time``, over any cut and order of the input.

    ``time`` is a whole number of ``per_ms`` units a millisecond, later than a day before zero.
    ``delay_ms`` is how much earlier than the latest time seen a row may still come
    (``harness.disorder`` measures it for files). ``progress`` moves the watermark in place of ``time``, in its unit: a bound
    that rows to come are not at or before.
    """
    micros = (F.col(time) if progress is None else progress) * (1000 // per_ms) + SHIFT_MS * 1000
    timed = stream.withColumn("_at", F.timestamp_micros(micros)).withWatermark("_at", f"{delay_ms} milliseconds")
    kinds = [f.dataType.simpleString() for f in stream.schema]
    return timed.groupBy(*names(keys)).transformWithStateInPandas(
        statefulProcessor=Ordered(processor, stream.columns, kinds, time, per_ms),
        outputStructType=schema, outputMode="Append", timeMode="EventTime",
    )


def _uses_ttl(processor: StatefulProcessor) -> bool:
    return getattr(processor, "ttl_ms", None) is not None
