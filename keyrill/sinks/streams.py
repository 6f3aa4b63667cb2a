"""Sinks of streaming queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from keyrill.operators.transforms import labelled
from keyrill.sinks.files import filesystem


def append_batches(path: str):
    """A ``foreachBatch`` function that writes rows with the time they were processed.

    A batch writes to its own folder and replaces it, so a repeated batch does no harm.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("processed_at", F.current_timestamp())
        stamped.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    return write


def to_console(stream: DataFrame, label: str | None = None, mode: str = "append"):
    """A writer that prints rows on the driver, each under a label if one is given."""
    shown = labelled(stream, label, stream.columns).select("line") if label else stream
    return shown.writeStream.outputMode(mode).format("console").option("truncate", "false")


def watermark_of(query) -> str | None:
    """The watermark after the last micro-batch of a query."""
    progress = query.lastProgress
    return (progress or {}).get("eventTime", {}).get("watermark")


class FileRowSink:
    """A ``foreach`` object: ``open`` per partition and epoch, ``process`` per row, ``close``.

    ``folder`` is an address every executor can write to (``files.qualified``). The file name is
    made of partition and epoch, so a repeated epoch replaces its file.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.fs, base = filesystem(self.folder)
        self.fs.create_dir(base, recursive=True)
        self.target = f"{base}/epoch-{epoch_id:06d}-part-{partition_id:05d}.txt"
        self.open_name = f"{base}/_{uuid.uuid4().hex}.tmp"  # readers skip names with an underscore
        self.stream = self.fs.open_output_stream(self.open_name)
        return True

    def process(self, row: Row) -> None:
        self.stream.write(("\t".join("" if v is None else str(v) for v in row) + "\n").encode())

    def close(self, error) -> None:
        self.stream.close()
        if error is None:
            self.fs.move(self.open_name, self.target)
        else:
            self.fs.delete_file(self.open_name)
