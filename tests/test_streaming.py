"""Streams give the rows of their batch forms, however the input is cut and restarted."""

import glob
import os
import shutil

import pytest
from compare import differences, views
from pyspark.sql import functions as F

from keyrill.catalog import batch, stream
from keyrill.catalog.oracle import ORACLE
from keyrill.sources.collections import rows
from keyrill.sources.text import stream_lines
from keyrill.sinks.streams import FileRowSink, append_batches, to_console, watermark_of
from keyrill.streaming import processors
from keyrill.streaming.harness import disorder, run_until_idle, start_to_parquet, state_settings, stream_table
from keyrill.streaming.processors import keyed_state
from keyrill.streaming.recovery import checkpointed_writer

FILES = 5


ORDERS = {
    "in_order": lambda total, i: (F.col("event_id") >= total * i // FILES) & (F.col("event_id") < total * (i + 1) // FILES),
    "newest_first": lambda total, i: (F.col("event_id") >= total * (FILES - 1 - i) // FILES)
    & (F.col("event_id") < total * (FILES - i) // FILES),
    "interleaved": lambda total, i: F.col("event_id") % FILES == i,
}


@pytest.fixture(scope="module")
def cuts(spark, sf_dir, tmp_path_factory):
    """The events table as five files, each read as a micro-batch, in several orders."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").coalesce(1)
    total = events.agg(F.max("event_id")).head()[0] + 1
    folders = {}
    for name, rows_of in ORDERS.items():
        folders[name] = str(tmp_path_factory.mktemp(name))
        for i in range(FILES):
            part = f"{folders[name]}/part{i}"
            events.filter(rows_of(total, i)).write.parquet(part)
            [written] = glob.glob(f"{part}/*.parquet")
            shutil.copy(written, f"{folders[name]}/events-{i}.parquet")
            os.utime(f"{folders[name]}/events-{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return folders


@pytest.fixture(scope="module")
def cut_events(cuts):
    return cuts["in_order"]


def as_rows(frame):
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=repr)


ORDERED = (
    "s_running_sum s_running_max_by s_last_value_state s_last_value_ttl s_marker_segments s_idle_timeout_count s_timer_echo "
    "s_broadcast_enrich s_interval_join s_session_cogroup s_bounded_lateness s_count_window "
    "s_session_join s_count_window_all s_marker_segments_global"
).split()
CASES = [(name, "newest_first") for name in ORDERED] + [
    (name, "interleaved") for name in ("s_marker_segments", "s_idle_timeout_count", "s_session_cogroup", "s_session_join", "s_marker_segments_global")
] + [("s_co_process", "in_order"), ("s_running_sum", "in_order")]


@pytest.mark.parametrize(("name", "order"), CASES)
def test_any_cut_and_order_of_files(spark, sf_dir, cuts, monkeypatch, name, order):
    def cut_table(session, folder, table, schema=None, **_):
        return stream_table(session, cuts[order], table, max_files=1, schema=schema)

    monkeypatch.setattr(stream, "stream_table", cut_table)
    monkeypatch.setattr(stream, "disorder", lambda session, folder, *rest: disorder(session, cuts[order], *rest))
    assert differences(stream.QUERIES[name](spark, sf_dir), views(sf_dir), ORACLE[name]) is None


def test_disorder_of_files(spark, cuts):
    ids = {name: disorder(spark, folder, "events", F.col("event_id")) for name, folder in cuts.items()}
    assert ids["in_order"] < ids["interleaved"] <= ids["newest_first"] + FILES


def test_null_values_as_in_the_batch_form(spark, tmp_path):
    rows(spark, [(0, "k", None), (1, "k", 3), (2, "k", None)], "seq long, key string, v long").write.parquet(f"{tmp_path}/in/p")
    read = spark.readStream.schema("seq long, key string, v long").parquet(f"{tmp_path}/in/p")
    sums = keyed_state(
        read, "key", processors.RunningSum(["key"], ["seq"], "v", "s"), "seq long, key string, v long, s long"
    )
    start_to_parquet(sums.select("seq", "s"), str(tmp_path)).awaitTermination()
    assert as_rows(spark.read.parquet(f"{tmp_path}/out")) == sorted([(None, 0), (3, 1), (3, 2)], key=repr)
    best = keyed_state(
        read, "key", processors.RunningMaxBy(["key"], ["seq"], "v", ["seq", "v"], "seq long, v long"),
        "key string, seq long, max_seq long, max_v long",
    )
    start_to_parquet(best.select("seq", "max_seq"), f"{tmp_path}/best").awaitTermination()
    assert as_rows(spark.read.parquet(f"{tmp_path}/best/out")) == [(0, 0), (1, 1), (1, 2)]


def test_stop_and_resume(spark, sf_dir, cut_events, tmp_path):
    """A query stopped after part of the input goes on where it was."""
    source = tmp_path / "input"
    source.mkdir()
    for files in (range(2), range(2, FILES)):
        for i in files:
            shutil.copy2(f"{cut_events}/events-{i}.parquet", source)
        schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
        events = stream.with_time(stream_table(spark, str(source), "events", max_files=1, schema=schema))
        windows = keyed_state(
            events.select("event_id", "user_id", "event_type", "cents"), "user_id",
            processors.CountWindow(["user_id"], ["event_id"], 2, "event_type", "cents"),
            "user_id bigint, window_no bigint, names string, total bigint",
        )
        start_to_parquet(windows, str(tmp_path)).awaitTermination()
    expected = batch.QUERIES["count_window_reduce"](spark, sf_dir).drop("first_id")
    assert as_rows(spark.read.parquet(f"{tmp_path}/out")) == as_rows(expected)


def test_checkpoint_interval(spark, sf_dir, tmp_path):
    writer = checkpointed_writer(stream_table(spark, sf_dir, "region"), f"{tmp_path}/c").format("noop")
    query = writer.queryName("by the second").start()
    try:
        query.processAllAvailable()
        assert query.name == "by the second" and query.lastProgress["batchId"] >= 0
    finally:
        query.stop()
    assert os.path.isdir(f"{tmp_path}/c/commits")


def test_last_value_held_within_a_batch(spark, tmp_path):
    rows(spark, [(0, "k", 666), (1, "k", 7)], "seq long, key string, v int").write.parquet(f"{tmp_path}/in/p")
    read = spark.readStream.schema("seq long, key string, v int").parquet(f"{tmp_path}/in/p")
    held = keyed_state(
        read, "key", processors.LastValue(["key"], ["seq"], "v", "int", 100_000, "previous"),
        "seq long, key string, v int, previous int",
    )
    assert as_rows(run_until_idle(held, "held", partitions=2)) == [("k", 666, 1, 7), ("k", None, 0, 666)]


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two\nthree\n")
    lines = stream_lines(spark, str(tmp_path), max_files=1)
    assert lines.isStreaming and lines.columns == ["line"]


def test_batch_sink_is_repeatable(spark, tmp_path):
    write = append_batches(f"{tmp_path}/rows")
    frame = rows(spark, [(1,), (2,)], "v int")
    write(frame, 0)
    write(frame, 0)
    write(frame, 1)
    stored = spark.read.parquet(f"{tmp_path}/rows")
    assert stored.count() == 4 and "processed_at" in stored.columns


def test_row_sink_keeps_only_finished_files(tmp_path):
    for error in (RuntimeError("lost"), None):
        sink = FileRowSink(str(tmp_path / "out"))
        assert sink.open(0, 3)
        sink.process(("a", None, 1))
        sink.close(error)
    assert [p.read_text() for p in (tmp_path / "out").glob("*.txt")] == ["a\t\t1\n"]


def test_watermark(spark, sf_dir, tmp_path):
    events = stream.timed_stream(spark, sf_dir).withWatermark("ts", "0 seconds")
    counts = events.groupBy("user_id", F.session_window("ts", "1 hour")).count()
    with state_settings(spark, 2):
        query = counts.writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    query.awaitTermination()
    assert watermark_of(query).startswith("2024-")


def test_console(spark, sf_dir, tmp_path):
    # The JVM prints past the capture of the test runner, so only the run is checked.
    writer = to_console(stream_table(spark, sf_dir, "region"), "regions")
    query = writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["sink"]["numOutputRows"] == 5


def test_a_row_bridges_two_open_sessions():
    import numpy as np

    from keyrill.streaming.sessions import merged

    bounds = [(0, 10, 7), (30, 40, 8), (90, 95, 9)]
    found = merged(bounds, np.array([20, 60, 52, 200]), 10)
    assert [(a, b, n, p.tolist()) for a, b, n, p in found] == [(0, 40, [7, 8], [0]), (52, 60, [], [2, 1]), (200, 200, [], [3])]
    assert merged(bounds, np.array([96]), 10)[0][:3] == (90, 96, [9])


def test_parting_again_gives_the_same_rows(spark, tmp_path):
    """A micro-batch that is run again finds its watermark in the log."""
    from keyrill.streaming.late import part_late

    store = part_late(str(tmp_path), "time", 10)
    parts = [[(1, 100), (2, 95), (3, None)], [(4, 90), (5, 91), (6, 130)], [(7, 120), (8, 121)]]
    frames = [rows(spark, p, "id long, time long") for p in parts]
    for number, frame in enumerate(frames):
        store(frame, number)
        store(frame, number)
    on_time = spark.read.parquet(f"{tmp_path}/on_time").orderBy("id").select("id", "horizon").collect()
    assert [tuple(r) for r in on_time] == [(1, 94), (2, 94), (5, 90), (6, 90), (8, 120)]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/late").collect()) == [3, 4, 7]
