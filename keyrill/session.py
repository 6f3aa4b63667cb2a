"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_root: str | None = None


def build_session(master: str | None = None, name: str = "keyrill", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Adaptive execution stays on: it sizes shuffle partitions, turns a join into a
    broadcast once the measured side is small, and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under the shared checkpoint folder of the cluster.

    Where ``spark.checkpoint.dir`` is unset (local runs) one temporary root per
    process is used instead.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="keyrill-")
        root = _local_root
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
