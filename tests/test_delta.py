import random

import pytest
from pyspark.sql import functions as F

from keyrill.operators.delta import delta_iterate


def walk(edges, start, seen=None):
    def step(changed):
        if seen is not None:
            seen.append(sorted(map(tuple, changed.collect())))
        return changed.join(edges, changed["node"] == edges["src"]).select(F.col("dst").alias("node"), "label")

    return delta_iterate(start, step, "node", "label", 50)


def test_least_label_that_reaches_a_node(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(80)] + [(100 + i, 101 + i) for i in range(12)]
    seeds = [3, 17, 40, 100]
    expected = {}
    for seed in sorted(seeds):
        todo = [seed]
        while todo:
            node = todo.pop()
            if node not in expected:
                expected[node] = seed
                todo += [b for a, b in edges if a == node]
    frame = spark.createDataFrame(edges, "src long, dst long")
    start = spark.createDataFrame([(s, s) for s in seeds], "node long, label long")
    seen = []
    assert dict(map(tuple, walk(frame, start, seen).collect())) == expected
    # Only what a round changed goes into the next one; on the chain that is one node.
    assert seen[0] == [(s, s) for s in seeds]
    assert all(len([n for n, _ in rows if n >= 100]) <= 1 for rows in seen)
    assert len(seen) <= 60


def test_edge_cases(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (1, 1), (None, 5), (2, None)], "src long, dst long")
    start = spark.createDataFrame([(1, 7), (1, 7), (1, 9), (4, None), (None, 8)], "node long, label long")
    found = set(map(tuple, walk(edges, start).collect()))
    assert found == {(1, 7), (2, 7), (None, 7)}
    assert walk(edges, start.limit(0)).collect() == []


def test_a_loop_that_does_not_end(spark):
    start = spark.createDataFrame([(0, 0)], "node long, label long")
    with pytest.raises(RuntimeError, match="3 iterations"):
        delta_iterate(start, lambda rows: rows.select("node", (F.col("label") - 1).alias("label")), "node", "label", 3)
