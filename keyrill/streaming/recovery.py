"""Checkpointing of streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: checkpoint interval.
CHECKPOINT_INTERVAL = "1 second"


def checkpointed_writer(stream: DataFrame, checkpoint: str, interval: str = CHECKPOINT_INTERVAL):
    """A writer that records its progress every ``interval``; the checkpoint stays after a stop.

    A query started again with the same checkpoint goes on where the last one stopped. How
    often a failed job is tried again is a matter of the cluster's scheduler.
    """
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=interval)
