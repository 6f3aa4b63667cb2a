"""Tables written once to the folder that the whole cluster shares."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from keyrill.session import work_dir

_written: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which also cuts its lineage.

    The files are removed when the driver's Python ends.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _clean() -> None:
    for spark, path in _written:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session may be gone already
            return
