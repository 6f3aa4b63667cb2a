"""A user's aggregate: one accumulator per key and task, merged behind the shuffle."""

import pytest
from pyspark.sql import functions as F

from keyrill.catalog.batch import Spread
from keyrill.operators import aggregates
from keyrill.operators.aggregates import aggregate_by, partials


@pytest.fixture(scope="module")
def frame(spark):
    """A hot key with a third of the rows, a null key, null values, and a key with no value."""
    data = [("hot" if i % 3 == 0 else f"k{i % 50}" if i % 7 else None, i % 4, None if i % 11 == 0 else i - 300) for i in range(3000)]
    data += [("none", 9, None), ("none", 9, None)]
    return spark.createDataFrame(data, "k string, part long, cents long").repartition(6)


def expected(rows, key):
    groups = {}
    for r in rows:
        groups.setdefault(key(r), []).append(r.cents)
    out = []
    for k, values in groups.items():
        known = [v for v in values if v is not None]
        total = sum(known)
        out.append((*k, len(known), total, int(total / len(known)) if known else None, max(known) - min(known) if known else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("held", [1, 1 << 16])
def test_aggregate_by(frame, monkeypatch, held):
    monkeypatch.setattr(aggregates, "MOST_HELD", held)
    rows = frame.collect()
    assert sorted((tuple(r) for r in aggregate_by(frame, "k", Spread()).collect()), key=repr) == expected(rows, lambda r: (r.k,))
    both = aggregate_by(frame, ["k", "part"], Spread())
    assert sorted((tuple(r) for r in both.collect()), key=repr) == expected(rows, lambda r: (r.k, r.part))
    assert aggregate_by(frame.limit(0), "k", Spread()).count() == 0


def test_a_hot_key_crosses_the_shuffle_as_one_row_per_task(frame):
    made = partials(frame, ["k"], Spread()).groupBy("k").agg(F.count("*").alias("n")).collect()
    assert len(made) > 30 and max(r.n for r in made) <= 6
