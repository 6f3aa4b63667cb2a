"""Session join of two streams.

The open sessions of a key are in state: an index of their bounds, and for each the rows of either side. A row begins a
session, extends one, or bridges several, which then become one, in whatever order rows come. The watermark
releases a session once no row can reach it any more; its pairs are given then, and its state goes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyrill.functions.ordering import names
from keyrill.streaming.processors import SHIFT_MS

# Times in full in the rows that wait as text.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
PAIRS_AT_ONCE = 1 << 16

SIDES = ("left", "right")


def merged(bounds: list[tuple[int, int, int]], times: np.ndarray, gap: int) -> list[tuple[int, int, list[int], np.ndarray]]:
    """Sessions that new rows belong to: first and last time, open sessions (numbers) in each, and the rows' places.

    ``bounds`` has (first, last, number) of the open sessions; rows and sessions not more than ``gap`` apart are one.
    """
    parts = [(first, last, number, -1) for first, last, number in bounds] + [(t, t, -1, i) for i, t in enumerate(times.tolist())]
    out: list[tuple[int, int, list[int], list[int]]] = []
    for first, last, number, row in sorted(parts):
        if not out or first - out[-1][1] > gap:
            out.append((first, last, [], []))
        first_so_far, last_so_far, numbers, places = out[-1]
        if number >= 0:
            numbers.append(number)
        else:
            places.append(row)
        out[-1] = (first_so_far, max(last_so_far, last), numbers, places)
    return [(a, b, numbers, np.array(places, np.int64)) for a, b, numbers, places in out if places]


class SessionJoin(StatefulProcessor):
    """Pairs of rows (as text) of both sides within a session, when the watermark has passed it by ``gap``."""

    def __init__(self, keys: Sequence[str], time: str, gap: int):
        self.keys, self.time, self.gap = list(keys), time, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "next bigint, bounds string")
        self.open = handle.getMapState("open", "number bigint", "left string, right string")

    def _bounds(self) -> tuple[int, list[tuple[int, int, int]]]:
        if not self.index.exists():
            return 0, []
        following, text = self.index.get()
        return following, [tuple(b) for b in json.loads(text)]

    def _wake(self, bounds: list[tuple[int, int, int]]) -> None:
        """One timer: where the first open session ends."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        if bounds:
            self.handle.registerTimer(min(last for _, last, _ in bounds) + self.gap + 1 + SHIFT_MS)

    def _keep(self, following: int, bounds: list[tuple[int, int, int]]) -> None:
        if bounds:
            self.index.update((following, json.dumps(bounds)))
        else:
            self.index.update((following, "[]"))
        self._wake(bounds)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        following, bounds = self._bounds()
        left = {number: (first, last) for first, last, number in bounds}
        sides, texts = frame["side"].to_numpy(object), frame["row"].to_numpy(object)
        for first, last, numbers, places in merged(bounds, frame[self.time].to_numpy(np.int64), self.gap):
            held = [[], []]
            for number in numbers:
                for lines, text in zip(held, self.open.getValue((number,)), strict=True):
                    if text:
                        lines.append(text)
                self.open.removeKey((number,))
                del left[number]
            for lines, side in zip(held, SIDES, strict=True):
                lines += texts[places[sides[places] == side]].tolist()
            number = numbers[0] if numbers else following
            following += not numbers
            self.open.updateValue((number,), tuple("\n".join(lines) for lines in held))
            left[number] = (first, last)
        self._keep(following, [(first, last, number) for number, (first, last) in left.items()])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() - SHIFT_MS
        following, bounds = self._bounds()
        closed = [b for b in bounds if b[1] + self.gap < watermark]
        for first, _, number in sorted(closed):
            left, right = (np.array(text.split("\n") if text else [], object) for text in self.open.getValue((number,)))
            self.open.removeKey((number,))
            if len(left) and len(right):
                step = max(1, PAIRS_AT_ONCE // len(right))
                for at in range(0, len(left), step):
                    some = left[at : at + step]
                    pairs = pd.DataFrame({"session_start": first, "left": np.repeat(some, len(right)), "right": np.tile(right, len(some))})
                    for i, name in enumerate(self.keys):
                        pairs.insert(i, name, [key[i]] * len(pairs))
                    yield pairs
        self._keep(following, [b for b in bounds if b[1] + self.gap >= watermark])

    def close(self) -> None: ...


def session_join(left: DataFrame, right: DataFrame, keys, time: str, gap: int, delay_ms: int) -> DataFrame:
    """Every pair of a left and a right row within one session, as ``left`` and ``right`` structs.

    ``time`` is in epoch milliseconds, later than a day before zero, and so is ``gap``. A session is given once the watermark,
    ``delay_ms`` behind the latest time seen, is more than ``gap`` past its last row. Rows wait as JSON text.
    """
    key_names = names(keys)

    def tagged(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*key_names, time, F.lit(side).alias("side"), F.to_json(F.struct(*rows.columns), JSON).alias("row"))

    both = tagged(left, SIDES[0]).unionByName(tagged(right, SIDES[1]))
    at = F.timestamp_micros((F.col(time) + SHIFT_MS) * 1000)
    timed = both.withColumn("_at", at).withWatermark("_at", f"{delay_ms} milliseconds")
    kinds = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in key_names)
    pairs = timed.groupBy(*key_names).transformWithStateInPandas(
        statefulProcessor=SessionJoin(key_names, time, gap),
        outputStructType=f"{kinds}, session_start bigint, left string, right string",
        outputMode="Append", timeMode="EventTime",
    )
    sides = [F.from_json(side, rows.schema, JSON).alias(side) for side, rows in zip(SIDES, (left, right), strict=True)]
    return pairs.select(*key_names, "session_start", *sides)
