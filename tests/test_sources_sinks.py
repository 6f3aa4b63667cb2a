"""Sources and sinks on their own."""

import pytest
from pyspark.sql import functions as F

from keyrill.operators.transforms import RichFunction, rich_flat_map
from keyrill.sinks.files import LineSink, write_lines
from keyrill.sources.collections import rows, sequence
from keyrill.sources.kafka import decode_messages, kafka_options
from keyrill.sources.text import read_lines


def test_text_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_lines(rows(spark, [("old",), ("older",)], "value string"), path)
    write_lines(rows(spark, [("new",)], "value string"), path)
    assert [r["line"] for r in read_lines(spark, path).collect()] == ["new"]


def test_line_writer(spark, tmp_path):
    spark.dataSource.register(LineSink)
    path = str(tmp_path / "lines")
    numbers = sequence(spark, 0, 99, partitions=4).select("v", (F.col("v") * 2).alias("w"))
    numbers.write.format("lines").mode("append").save(path)
    assert sorted(p.name[:4] for p in (tmp_path / "lines").glob("part-*")) == ["part"] * 4
    fields = F.split("line", "\t")
    back = read_lines(spark, path).select(fields[0].cast("long"), fields[1].cast("long"))
    assert sorted(map(tuple, back.collect())) == [(v, 2 * v) for v in range(100)]
    numbers.limit(1).write.format("lines").mode("overwrite").save(path)
    assert read_lines(spark, path).count() == 1


def test_failed_write_shows_nothing(spark, tmp_path):
    spark.dataSource.register(LineSink)
    path = str(tmp_path / "lines")
    bad = sequence(spark, 0, 9).select(F.when(F.col("v") == 9, F.raise_error(F.lit("bad row"))).otherwise("x"))
    with pytest.raises(Exception, match="bad row"):
        bad.write.format("lines").mode("append").save(path)
    # A task that was still running may recreate the hidden staging folder, never a result.
    assert not [p for p in (tmp_path / "lines").glob("*") if not p.name.startswith("_")]
    assert not (tmp_path / "lines" / "_SUCCESS").exists()


def test_kafka_decode(spark):
    records = rows(spark, [("a",), ("ERROR",)], "v string").select(
        F.col("v").cast("binary").alias("value"), F.timestamp_millis(F.lit(1234)).alias("timestamp")
    )
    assert sorted(map(tuple, decode_messages(records).collect())) == [("ERROR", 1234), ("a", 1234)]
    assert decode_messages(records, F.current_timestamp()).first()["event_time"] > 1_700_000_000_000


def test_kafka_options():
    assert kafka_options("h:1", "t", group="g")["startingOffsets"] == "earliest"
    assert kafka_options("h:1", "t", start="latest", max_offsets=9)["maxOffsetsPerTrigger"] == "9"


def test_rich_function_lifecycle(spark, tmp_path):
    # A local class, as test modules are not on the path of the workers.
    class Lifecycle(RichFunction):
        def __init__(self, folder):
            self.folder = folder

        def open(self, partition):
            self.log = [f"open {partition}"]

        def flat_map(self, batch):
            yield batch
            yield batch

        def close(self):
            with open(f"{self.folder}/{self.log[0][5:]}", "w") as out:
                out.write(" ".join([*self.log, "close"]))

    folder = str(tmp_path)
    twice = rich_flat_map(sequence(spark, 1, 3, partitions=1), lambda: Lifecycle(folder), "v bigint")
    assert sorted(r["v"] for r in twice.collect()) == [1, 1, 2, 2, 3, 3]
    assert (tmp_path / "0").read_text() == "open 0 close"
