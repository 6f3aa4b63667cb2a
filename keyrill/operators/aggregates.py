"""A user's own aggregate per key, in two phases.

Each task folds its rows into one accumulator per key before the shuffle, so a hot key crosses it as one row per task;
behind it the accumulators of a key are merged one by one as they stream by in the order of the keys.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from keyrill.functions.ordering import Key, names, with_keys

# Most accumulators a task holds before it passes them on.
MOST_HELD = 1 << 16


class Aggregate:
    """An aggregate function: ``create``, ``add`` and ``merge`` accumulators, and give the ``result``.

    Accumulators must be picklable. ``schema`` names the columns of ``result``. ``merge`` must not depend on the
    order or grouping of its calls.
    """

    schema: str

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, accumulator: Any, rows: pa.RecordBatch) -> Any:
        """The accumulator with the rows of one key in a batch."""
        raise NotImplementedError

    def merge(self, one: Any, other: Any) -> Any:
        raise NotImplementedError

    def result(self, accumulator: Any) -> tuple:
        raise NotImplementedError


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each key of a batch, in their order."""
    if not batch.num_rows:
        return
    codes = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        coded = batch.column(key).dictionary_encode(null_encoding="encode")
        codes = codes * len(coded.dictionary) + coded.indices.to_numpy()
        codes = np.unique(codes, return_inverse=True)[1].reshape(-1)  # small again before the next key
    order = np.argsort(codes, kind="stable")
    ends = np.flatnonzero(np.append(np.diff(codes[order]) != 0, True)) + 1
    ordered = batch.take(pa.array(order))
    begin = 0
    for end in ends.tolist():
        rows = ordered.slice(begin, end - begin)
        yield tuple(rows.column(k)[0].as_py() for k in keys), rows
        begin = end


def partials(df: DataFrame, keys: list[str], aggregate: Aggregate) -> DataFrame:
    """An accumulator for each key and task."""
    schema = df.select(*keys).schema
    held_schema = schema.add("accumulator", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def passed_on() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kinds[i]) for i in range(len(keys))]
            packed = pa.array([pickle.dumps(h[0]) for h in held.values()], pa.binary())
            return pa.RecordBatch.from_arrays([*columns, packed], names=[*keys, "accumulator"])

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            for key, rows in _runs(batch, keys):
                slot = held.setdefault(key, [None])
                slot[0] = aggregate.add(aggregate.create() if slot[0] is None else slot[0], rows)
            if len(held) > MOST_HELD:
                yield passed_on()
                held.clear()
        if held:
            yield passed_on()

    return df.mapInArrow(run, held_schema)


def aggregate_by(df: DataFrame, keys: Key | Sequence[Key], aggregate: Aggregate) -> DataFrame:
    """A row per key with the result of a user's aggregate over its rows."""
    df, key_names = with_keys(df, keys)
    schema = df.select(*key_names).schema
    out = names(key_names)
    fields = list(to_arrow_schema(StructType.fromDDL(aggregate.schema)))
    whole = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), aggregate.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, accumulator, done, like = None, None, [], None

        def finished() -> pa.RecordBatch:
            results = [aggregate.result(a) for _, a in done]
            columns = [pa.array([k[i] for k, _ in done], like.field(n).type) for i, n in enumerate(out)]
            columns += [pa.array(c, f.type) for c, f in zip(zip(*results, strict=True), fields, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[*out, *(f.name for f in fields)])

        for batch in batches:
            like = batch.schema
            lists = [batch.column(k).to_pylist() for k in out]
            for at, packed in enumerate(batch.column("accumulator").to_pylist()):
                key = tuple(column[at] for column in lists)
                other = pickle.loads(packed)
                if now == (key,):
                    accumulator = aggregate.merge(accumulator, other)
                else:
                    if now is not None:
                        done.append((now[0], accumulator))
                    now, accumulator = (key,), other
            if done:
                yield finished()
                done = []
        if now is not None:
            done.append((now[0], accumulator))
            yield finished()

    dealt = partials(df, key_names, aggregate).repartition(*[F.col(k) for k in key_names]).sortWithinPartitions(*key_names)
    return dealt.mapInArrow(run, whole)
