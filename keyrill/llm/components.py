"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize


def components(edges: DataFrame, kind: str = "long") -> DataFrame:
    """Rows (node, component): the smallest node reachable from each node of ``edges`` (a, b).

    Rounds of two steps: every node links its larger neighbours to its smallest one, then
    its smaller neighbours to the smallest. All are joins and aggregates, so no component
    is ever in one place. Each round is written to the shared folder; the rounds end when
    one changes nothing, after about the logarithm of the longest path. Nodes compare as
    signed numbers or as text, according to ``kind``.
    """
    pairs = edges.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b")).filter("a != b")
    current = materialize(_ordered(pairs), "components")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours to the smallest of the neighbourhood.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Smaller neighbours, and the node itself, to the smallest of these.
        down = _ordered(large)
        smallest = down.groupBy("b").agg(F.min("a").alias("m"))
        small = down.join(smallest, "b").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").filter("a != b")
        current = materialize(_ordered(small), "components")
        before, state = state, _state(current)
        if before == state:
            break
    # Now every edge runs from the smallest node of a component to another one.
    return current.select(F.col("b").alias("node"), F.col("a").alias("component"))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).head()
    return row["n"], row["s"]
