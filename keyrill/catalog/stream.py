"""Streaming queries over the supplied tables, run to the end of their input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.catalog.batch import user_time_text
from keyrill.catalog.tables import HOUR, MINUTE, of_type, table, with_time
from keyrill.functions.text import explode_lines, explode_tokens
from keyrill.operators.compose import connect
from keyrill.operators.interval import interval_join
from keyrill.session import work_dir
from keyrill.sinks.files import qualified, write_lines
from keyrill.sinks.streams import FileRowSink, append_batches
from keyrill.sources.kafka import bounded_lateness, decode_messages
from keyrill.sources.text import read_lines, stream_lines
from keyrill.streaming import late, overall, processors
from keyrill.streaming import sessions as open_sessions
from keyrill.streaming.harness import disorder, run_append, run_flushed, state_settings, stream_table
from keyrill.streaming.processors import ordered_state

QUERIES: dict = {}

# The closing row of a flushed stream: a key no table holds, far ahead in time.
CLOSING = {"event_id": 4_000_000_000_000_000, "user_id": -1, "event_type": "closing", "ts": datetime(2100, 1, 1)}

# Items of a segment's part, and how long a held value lives, in milliseconds.
PART_ITEMS = 10
TTL = 100_000


def query(function):
    QUERIES[function.__name__] = function
    return function


def event_stream(spark, folder) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stream = stream_table(spark, folder, "events", schema=table(spark, folder, "events").schema)
    return with_time(stream)


def timed_stream(spark, folder) -> DataFrame:
    """Events as the flushed queries read them, with ``ts`` as an instant."""
    stream = event_stream(spark, folder)
    return stream.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))


def with_millis(stream: DataFrame) -> DataFrame:
    return stream.withColumn("time", F.unix_millis("ts"))


def lateness(spark, folder) -> str:
    """How far events may lie before events read earlier, as a watermark delay."""
    return f"{disorder(spark, folder, 'events', F.unix_millis(F.col('ts').cast('timestamp')))} milliseconds"


def in_event_order(spark, folder, keep, processor, schema: str, name: str) -> DataFrame:
    """Run a processor over the events by user and event_id; ``keep`` picks its columns.

    The stream is closed by a far row of a user of its own, so every row leaves the buffer.
    """
    delay = disorder(spark, folder, "events", F.col("event_id"), 1000)
    stream = event_stream(spark, folder).select("event_id", "user_id", "event_type", "ts", "value", "props")

    def built(rows: DataFrame) -> DataFrame:
        return ordered_state(keep(with_time(rows)), "user_id", processor, schema, "event_id", delay, 1000)

    return run_flushed(spark, stream, built, CLOSING, name)


# Sources and sinks


def _words(spark, folder) -> DataFrame:
    customers = stream_table(spark, folder, "customer", schema=table(spark, folder, "customer").schema)
    return customers.select(F.concat(F.lit("word"), F.col("c_custkey")).alias("word"), "c_mktsegment")


@query
def s_counter_source(spark, folder):
    return run_append(_words(spark, folder), "words")


@query
def s_parallel_source(spark, folder):
    # Every subtask gives all words.
    subtask = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("subtask")
    return run_append(_words(spark, folder).select("word", subtask, "c_mktsegment"), "parallel-words")


@query
def s_lines_word_count(spark, folder):
    path, out = work_dir(spark, "lines"), work_dir(spark, "counts")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    write_lines(explode_lines(documents, "text").select("line"), path)
    words = explode_tokens(stream_lines(spark, path), "line", token="word")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    writer = counts.writeStream.outputMode("update").foreachBatch(append_batches(f"{out}/rows"))
    with state_settings(spark):
        running = writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    # A micro-batch gives the new counts of the words it met; counts only grow.
    return spark.read.parquet(f"{out}/rows").groupBy("word").agg(F.max("n").alias("n"))


@query
def s_foreach_batch_sink(spark, folder):
    out = work_dir(spark, "batches")
    stream = event_stream(spark, folder).select("event_id", "event_type", "cents")
    writer = stream.writeStream.foreachBatch(append_batches(f"{out}/rows")).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{out}/checkpoint").start().awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("processed_at", "batch_id")


@query
def s_foreach_sink(spark, folder):
    out = work_dir(spark, "rows")
    stream = event_stream(spark, folder).select("event_id", "event_type")
    writer = stream.writeStream.foreach(FileRowSink(qualified(spark, f"{out}/rows"))).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{out}/checkpoint").start().awaitTermination()
    fields = F.split("line", "\t")
    return read_lines(spark, f"{out}/rows").select(
        fields[0].cast("bigint").alias("event_id"), fields[1].alias("event_type")
    )


# Several inputs


@query
def s_co_process(spark, folder):
    left, right = event_stream(spark, folder), event_stream(spark, folder)
    stream = connect(of_type(left, "click"), of_type(right, "purchase"), user_time_text, user_time_text)
    return run_append(stream, "co-process")


@query
def s_broadcast_enrich(spark, folder):
    def keep(events: DataFrame) -> DataFrame:
        return events.filter(F.col("event_type").isin("signup", "purchase", "closing")).select(
            "user_id", "event_id",
            F.when(F.col("event_type") == "signup", F.col("props")).alias("told"),
            (F.col("event_type") == "purchase").alias("is_event"),
        )

    known = processors.AsOfEnrich(["user_id"], ["event_id"], [], "name")
    return in_event_order(spark, folder, keep, known, "user_id bigint, event_id bigint, name string", "as-of")


@query
def s_interval_join(spark, folder):
    # The same minute cut as in the batch query, as instants.
    minute = F.timestamp_millis((F.floor(F.unix_millis("ts") / MINUTE) * MINUTE).cast("bigint"))
    delay = f"{lateness(spark, folder)} 1 minute"

    def side(kind: str, name: str) -> DataFrame:
        rows = of_type(timed_stream(spark, folder), kind)
        timed = rows.select("user_id", F.col("event_id").alias(f"{name}_id"), minute.alias(f"{name}_time"))
        return timed.withWatermark(f"{name}_time", delay)

    joined = interval_join(
        side("click", "left"), side("purchase", "right"), "user_id", "left_time", "right_time",
        -6 * HOUR, 6 * HOUR, inclusive=False,
    )
    return run_append(joined.select("user_id", "left_id", "right_id"), "interval-join")


@query
def s_session_cogroup(spark, folder):
    delay = lateness(spark, folder)

    def grouped(stream: DataFrame) -> DataFrame:
        timed = stream.withColumn("at", F.timestamp_millis(F.unix_millis("ts"))).withWatermark("at", delay)
        kept = timed.filter(F.col("event_type").isin("click", "purchase", "closing"))
        groups = kept.groupBy("user_id", F.session_window("at", "24 hours").alias("s")).agg(
            F.count_if(F.col("event_type") == "click").alias("n_left"),
            F.count_if(F.col("event_type") == "purchase").alias("n_right"),
        )
        return groups.select("user_id", F.unix_millis("s.start").alias("session_start"), "n_left", "n_right")

    return run_flushed(spark, timed_stream(spark, folder), grouped, CLOSING, "cogroup")


@query
def s_session_join(spark, folder):
    delay = disorder(spark, folder, "events", F.unix_millis(F.col("ts").cast("timestamp")))

    def joined(stream: DataFrame) -> DataFrame:
        timed = with_millis(stream).select("event_id", "user_id", "event_type", "time")
        left = timed.filter(F.col("event_type").isin("click", "closing"))
        return open_sessions.session_join(left, of_type(timed, "purchase"), "user_id", "time", 24 * HOUR, delay)

    pairs = run_flushed(spark, timed_stream(spark, folder), joined, CLOSING, "session-join")
    text = F.format_string("%d == %d", F.col("left.user_id"), F.col("right.user_id"))
    return pairs.select(
        "user_id", "session_start", F.col("left.event_id").alias("left_id"), F.col("right.event_id").alias("right_id"), text.alias("text")
    )


# All rows in order, without a key. Events of a cell wait together.

EVENTS_PER_CELL = 1 << 16


def in_closed_cells(spark, folder, sink, name: str) -> str:
    delay = disorder(spark, folder, "events", F.col("event_id"), 1000)
    stream = event_stream(spark, folder).select("event_id", "user_id", "event_type", "ts", "value", "props")

    def built(rows: DataFrame) -> DataFrame:
        kept = with_time(rows).select("event_id", "event_type", "cents")
        return overall.closed_cells(kept, "event_id", EVENTS_PER_CELL, delay, 1000)

    return run_flushed(spark, stream, built, CLOSING, name, sink=sink)


@query
def s_count_window_all(spark, folder):
    def joined(a, b):
        return F.struct(
            a["event_id"].alias("event_id"), F.concat(a["event_type"], b["event_type"]).alias("event_type"),
            (a["cents"] + b["cents"]).alias("cents"),
        )

    out = in_closed_cells(spark, folder, lambda f: overall.count_windows_all(f, "event_id", 4, joined), "count-window-all")
    return spark.read.parquet(f"{out}/out").select(
        "window_no", F.col("result.event_id").alias("first_id"),
        F.col("result.event_type").alias("names"), F.col("result.cents").alias("total"),
    )


@query
def s_marker_segments_global(spark, folder):
    sink = lambda f: overall.segments_all(f, "event_id", "event_type", "error", PART_ITEMS)
    out = in_closed_cells(spark, folder, sink, "segments-all")
    return spark.read.parquet(f"{out}/out").drop("batch")


# Event time

# Fixed value: how late, in milliseconds, an event may be in the query of late rows.
ALLOWED = 6 * HOUR


def parted_events(spark, folder) -> tuple[str, DataFrame]:
    """Events by thirds of event_id, the last third first, each a micro-batch, parted at the allowed lateness."""
    work = work_dir(spark, "late")
    events = with_time(table(spark, folder, "events")).select("event_id", "user_id", "cents", "time")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).head()
    cuts = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high + 1]
    parts = [events.filter((F.col("event_id") >= a) & (F.col("event_id") < b)) for a, b in zip(cuts, cuts[1:])]
    # Closing rows, the second of which comes under the watermark of the first.
    closing = spark.createDataFrame([(CLOSING["event_id"], -1, 0, 4_000_000_000_000)], events.schema)
    for part in [parts[2], parts[0], parts[1], closing, closing]:
        part.write.mode("append").parquet(f"{work}/input")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/input")
        writer = stream.writeStream.foreachBatch(late.part_late(work, "time", ALLOWED)).trigger(availableNow=True)
        writer.option("checkpointLocation", f"{work}/checkpoint").start().awaitTermination()
    return work, events


@query
def s_late_rows(spark, folder):
    work, events = parted_events(spark, folder)
    on_time = spark.read.schema(events.schema).parquet(f"{work}/on_time/*").withColumn("is_late", F.lit(0))
    behind = late.late_rows(spark, work, events.schema).withColumn("is_late", F.lit(1))
    return on_time.unionByName(behind).filter("user_id >= 0").select("event_id", "user_id", "is_late")


@query
def s_on_time_idle_count(spark, folder):
    work, events = parted_events(spark, folder)
    stream = late.on_time_stream(spark, work, events.schema).select("user_id", "time", late.HORIZON)
    idle = processors.IdleTimeout(["user_id"], "time", 6 * HOUR)
    counted = ordered_state(stream, "user_id", idle, "user_id bigint, time bigint, count bigint", "time", 1, progress=F.col(late.HORIZON))
    return run_append(counted, "on-time-idle").filter("user_id >= 0")


@query
def s_bounded_lateness(spark, folder):
    # The bound of a day, or the disorder of the files if that is larger: no row is too late.
    millis = disorder(spark, folder, "events", F.unix_millis(F.col("ts").cast("timestamp")))
    bound = f"{max(24 * HOUR, millis)} milliseconds"

    def grouped(stream: DataFrame) -> DataFrame:
        records = stream.select("user_id", F.col("event_type").cast("binary").alias("value"), F.col("ts").alias("timestamp"))
        messages = decode_messages(records.withColumn("key", F.col("user_id")))
        timed = bounded_lateness(messages.withColumn("at", F.timestamp_millis("event_time")), "at", bound)
        sessions = timed.groupBy("message", F.session_window("at", "1 hour").alias("s")).agg(
            F.count(F.lit(1)).alias("n")
        )
        return sessions.select("message", F.unix_millis("s.start").alias("session_start"), "n")

    return run_flushed(spark, timed_stream(spark, folder), grouped, CLOSING, "lateness")


@query
def s_idle_timeout_count(spark, folder):
    delay = disorder(spark, folder, "events", F.unix_millis(F.col("ts").cast("timestamp")))

    def counted(stream: DataFrame) -> DataFrame:
        timed = with_millis(stream).select("user_id", "time")
        idle = processors.IdleTimeout(["user_id"], "time", 6 * HOUR)
        return ordered_state(timed, "user_id", idle, "user_id bigint, time bigint, count bigint", "time", delay)

    return run_flushed(spark, timed_stream(spark, folder), counted, CLOSING, "idle")


@query
def s_timer_echo(spark, folder):
    # One timer per user and instant: repeats of an instant go, whatever batch they come in.
    stream = timed_stream(spark, folder).withColumn("at", F.timestamp_millis(F.unix_millis("ts")))
    once = stream.withWatermark("at", lateness(spark, folder)).dropDuplicates(["user_id", "at"])
    return run_append(once.select("user_id", (F.unix_millis("at") + 6 * HOUR).alias("fire_time")), "echo")


# Keyed state


@query
def s_running_sum(spark, folder):
    return in_event_order(
        spark, folder, lambda e: e.select("event_id", "user_id", "cents"),
        processors.RunningSum(["user_id"], ["event_id"], "cents", "running_sum"),
        "event_id bigint, user_id bigint, running_sum bigint", "running-sum",
    )


@query
def s_running_max_by(spark, folder):
    return in_event_order(
        spark, folder, lambda e: e.select("event_id", "user_id", F.expr("cents div 1000").alias("score")),
        processors.RunningMaxBy(["user_id"], ["event_id"], "score", ["event_id", "score"], "event_id bigint, score bigint"),
        "user_id bigint, event_id bigint, max_event_id bigint, max_score bigint", "running-max",
    )


@query
def s_count_window(spark, folder):
    return in_event_order(
        spark, folder, lambda e: e.select("event_id", "user_id", "event_type", "cents"),
        processors.CountWindow(["user_id"], ["event_id"], 2, "event_type", "cents"),
        "user_id bigint, window_no bigint, names string, total bigint", "count-window",
    )


SEGMENTS = "user_id bigint, segment bigint, part bigint, size bigint, text string"


def segments_of() -> processors.MarkerSegments:
    return processors.MarkerSegments(["user_id"], ["event_id"], "event_type", "error", PART_ITEMS)


@query
def s_marker_segments(spark, folder):
    keep = lambda e: e.select("event_id", "user_id", "event_type")
    return in_event_order(spark, folder, keep, segments_of(), SEGMENTS, "segments")


def last_values(spark, folder, expires: int | None, name: str) -> DataFrame:
    held = processors.LastValue(
        ["user_id"], ["event_id"], "event_type", "string", None, "previous", time="time", expires=expires
    )
    return in_event_order(
        spark, folder, lambda e: e.select("event_id", "user_id", "event_type", "time"), held,
        "event_id bigint, user_id bigint, event_type string, previous string", name,
    )


@query
def s_last_value_state(spark, folder):
    return last_values(spark, folder, None, "last-value")


@query
def s_last_value_ttl(spark, folder):
    return last_values(spark, folder, TTL, "last-value-ttl")


@query
def s_restart_recovery(spark, folder):
    """Segments over several micro-batches; the query is stopped on the way and resumed from its checkpoint."""
    work = work_dir(spark, "recovery")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).head()
    cuts = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high + 1]
    closing = spark.createDataFrame([(CLOSING["event_id"], -1, "closing")], events.schema)
    # The last third first: rows come out of order across the stop.
    parts = [events.filter((F.col("event_id") >= a) & (F.col("event_id") < b)) for a, b in zip(cuts, cuts[1:])]
    store = append_batches(f"{work}/rows")
    delay = (high - low) // 1000 + 2
    for part in [parts[2], parts[0], parts[1], closing]:
        part.write.mode("append").parquet(f"{work}/input")
        read = spark.readStream.schema(events.schema).parquet(f"{work}/input")
        stream = ordered_state(read, "user_id", segments_of(), SEGMENTS, "event_id", delay, 1000)
        writer = stream.writeStream.foreachBatch(store).trigger(availableNow=True)
        with state_settings(spark):
            running = writer.option("checkpointLocation", f"{work}/checkpoint").start()
        running.awaitTermination()
    return spark.read.parquet(f"{work}/rows").drop("processed_at", "batch_id")
