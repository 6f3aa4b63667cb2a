"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyrill.session import work_dir

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    It cuts the lineage: later jobs read the files, also after executors are lost. The
    folder is removed when the driver's Python ends; the shuffle files of the write go when it has ended, as nothing reads them again.
    """
    return passing(df, purpose)[0]


def passing(df: DataFrame, purpose: str) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` as ``materialize`` gives it, and a call that removes its files once nothing will read them."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)
    remember(spark, path)
    return spark.read.schema(df.schema).parquet(path), lambda: _delete(spark, path)


def set_aside(docs: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[str], Column]]:
    """``docs`` with its other columns in one struct, and how to get a column of ``docs`` back from it.

    An operator that names columns of its own works on the first, so that no column of the caller's is taken
    for one of these; names compare without regard to case, as Spark's do. The struct is called ``_others``, which operators leave alone.
    """
    known = {u.lower() for u in used}
    others = [c for c in docs.columns if c.lower() not in known]
    held = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_others")] if others else []
    slim = docs.select(*[c for c in docs.columns if c.lower() in known], *held)
    return slim, lambda c: F.col("_others").getField(c).alias(c) if c in others else F.col(c)


def remember(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the driver's Python ends."""
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return
