"""Sharding by extendible hashing.

A directory is indexed by the first bits of a document's hash. A bucket above ``limit`` bytes is
split on its next bit, and only such buckets are, until every shard fits. The hash is that of
the document id; beyond its 32 bits come 32 bits of a running row number, which part even
rows of one id, however many. A single row above the limit cannot be split and is a shard
alone, at the first depth where it is.

Bytes are summed per cell of ``STEP`` more bits at a time, open buckets only, and rolled up
through the depths in between; a cell's depth is the first at which its bucket fits. A round
covers ``STEP`` bits, so its cells are bounded in number by the buckets that were open, and a
normal corpus takes two or three rounds. Sums combine on the map side: a hot id is
one row per task.

Defined cases: a null text has no bytes; null ids hash like the empty id; an empty table
gives no rows; documents without bytes share a bucket with any other. Extra columns pass
through ``assign``; columns named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize

LIMIT = 16 << 20
STEP = 12
BITS = 64
SHARDED = ["shard", "depth", "n_bytes"]


def _id_bits(doc_id: Column) -> Column:
    """32 bits of an id's MD5, as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def _cells(rows: DataFrame, done: int, limit: int) -> DataFrame:
    """Rows (cell, depth, open) for open buckets: ``cell`` has ``done + STEP`` bits.

    ``depth`` is where the cell's bucket fits; null where it is still too large at the end.
    """
    size = min(STEP, BITS - done)
    cells = rows.groupBy(F.substring("bits", 1, done + size).alias("cell")).agg(
        F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    depths = F.explode(F.sequence(F.lit(done), F.lit(done + size))).alias("at")
    spread = cells.select("cell", "bytes", "n", depths)
    buckets = spread.groupBy(F.expr("substring(cell, 1, at)").alias("bucket"), "at").agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n")
    )
    fits = buckets.filter((F.col("bytes") <= limit) | (F.col("n") == 1) | (F.col("at") == BITS)).select("bucket", F.col("at").alias("fit_at"))
    tried = spread.select("cell", "at", F.expr("substring(cell, 1, at)").alias("bucket"))
    found = tried.join(fits, (tried["bucket"] == fits["bucket"]) & (tried["at"] == fits["fit_at"]), "left")
    return found.groupBy("cell").agg(F.min("fit_at").alias("depth"))


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``shard`` (the bucket's bits as text), ``depth`` (their number) and ``n_bytes``."""
    names = [c for c in docs.columns if c not in SHARDED]
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 32))
    bits = F.concat(F.lpad(F.conv(_id_bits(F.col("doc_id")).cast("string"), 10, 2), 32, "0"), F.lpad(F.conv(number.cast("string"), 10, 2), 32, "0"))
    # Written once, so that row numbers are the same in every round.
    rows = materialize(
        docs.select(*names, bits.alias("bits"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")),
        "sharding",
    )
    settled, open_rows, done = None, rows, 0
    while True:
        cells = materialize(_cells(open_rows.select("bits", "n_bytes"), done, limit), "sharding-cells")
        size = min(STEP, BITS - done)
        placed = open_rows.withColumn("cell", F.substring("bits", 1, done + size)).join(cells, "cell")
        fit = placed.filter(F.col("depth").isNotNull()).select(
            *names, F.expr("substring(cell, 1, depth)").alias("shard"), F.col("depth").cast("int").alias("depth"), "n_bytes"
        )
        settled = fit if settled is None else settled.unionByName(fit)
        if not cells.filter(F.col("depth").isNull()).limit(1).count():
            return settled
        open_rows = placed.filter(F.col("depth").isNull()).select(*rows.columns)
        done += size


def directory(assigned: DataFrame) -> DataFrame:
    """Rows (shard, depth, documents, bytes), one per shard."""
    return assigned.groupBy("shard", "depth").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_bytes").alias("bytes")
    )


def write(assigned: DataFrame, path: str) -> None:
    """One folder per shard, its documents in a file."""
    assigned.repartition("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row per document: its bytes and its shard."""
    return assign(docs.select("doc_id", "text"), limit).select("doc_id", "n_bytes", "shard", "depth")
