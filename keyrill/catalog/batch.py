"""Batch queries over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyrill.catalog.tables import HOUR, MINUTE, events_of, of_type, table
from keyrill.functions.text import explode_lines, explode_tokens, lines_of, tokens_of, word_variants
from keyrill.operators import compose, count_windows, enrich, listed, regroup, rolling, segments, sessions, timeouts, transforms
from keyrill.operators.aggregates import Aggregate, aggregate_by
from keyrill.operators.interval import interval_join as join_within
from keyrill.operators.iterate import iterate
from keyrill.session import work_dir
from keyrill.sinks.files import LineSink, qualified, write_lines
from keyrill.sources.collections import rows, sequence
from keyrill.sources.kafka import decode_messages
from keyrill.sources.text import read_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PREFIX = "th"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def document_words(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return explode_tokens(explode_lines(documents, "text"), "line", token="word")


def conversation_lines(spark: SparkSession, folder: str) -> DataFrame:
    return explode_lines(table(spark, folder, "conversations").select("conv_id", "turn", "text"), "text")


# Fixed value: items of a segment's part, and values of a regrouped line.
PART_ITEMS = 10

# Sources


@query
def sequence_source(spark, folder):
    orders = table(spark, folder, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).head()
    numbers = sequence(spark, low, high)
    found = orders.select(F.col("o_orderkey").alias("v"), "o_orderpriority")
    return numbers.join(found, "v", "left")


@query
def literal_rows(spark, folder):
    # Five literal rows, so broadcasting them is safe at any size of the events.
    scores = rows(
        spark, [("view", 1), ("click", 2), ("signup", 3), ("purchase", 5), ("error", 0)], "event_type string, score int"
    )
    scored = table(spark, folder, "events").join(F.broadcast(scores), "event_type")
    return scored.groupBy("event_type", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("total_score")
    )


@query
def parallel_source_counts(spark, folder):
    # Four subtasks, each giving all numbers from 1000 on.
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    words = customers.select(
        F.concat(F.lit("word"), F.col("c_custkey") + 1000).alias("word"), "c_mktsegment",
        F.explode(F.sequence(F.lit(0), F.lit(3))).alias("subtask"),
    )
    return words.groupBy("word", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query
def kafka_decode(spark, folder):
    turns = table(spark, folder, "conversations")
    records = turns.select(
        F.col("conv_id").cast("string").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit("conversations").alias("topic"),
        F.col("turn").alias("offset"),
        F.timestamp_millis(F.col("conv_id") * 1000 + F.col("turn")).alias("timestamp"),
    )
    return decode_messages(records)


# Element transforms


@query
def map_pairs(spark, folder):
    return table(spark, folder, "events").select("event_id", F.col("event_type").alias("word"), F.lit(1).alias("num"))


@query
def tokenize(spark, folder):
    return document_words(spark, folder)


class SplitWords(transforms.RichFunction):
    """Words of the lines of a batch, each with the number 1, by Arrow kernels."""

    def open(self, partition):
        self.lines = 0

    def flat_map(self, batch):
        lines = batch.column("line")
        self.lines += len(lines)
        stripped = pc.utf8_rtrim(lines, characters=" ")
        kept = pc.or_(pc.equal(lines, ""), pc.not_equal(stripped, ""))
        words = pc.list_flatten(pc.split_pattern(pc.filter(stripped, kept), " "))
        ones = pa.array([1] * len(words), pa.int32())
        yield pa.RecordBatch.from_arrays([words, ones], names=["word", "num"])


@query
def rich_flat_map(spark, folder):
    lines = conversation_lines(spark, folder).select("line")
    return transforms.rich_flat_map(lines, SplitWords, "word string, num int")


@query
def map_vs_flatmap(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    parts = F.split("text", ",")
    mapped = turns.select("conv_id", "turn", F.lit("map").alias("form"), F.array_join(parts, "|").alias("value"))
    flat = turns.select("conv_id", "turn", F.lit("flat_map").alias("form"), F.explode(parts).alias("value"))
    return mapped.unionByName(flat)


@query
def filter_rows(spark, folder):
    return table(spark, folder, "events").filter(F.col("value") > 50).select("event_id", "value")


@query
def project_positions(spark, folder):
    return transforms.project(table(spark, folder, "events"), 2, 3)


def variants_of(words: DataFrame) -> DataFrame:
    kept = [c for c in words.columns if c != "word"]
    tagged = words.select(*kept, F.explode(word_variants(F.col("word"), PREFIX)).alias("v"))
    return tagged.select(*kept, "v.kind", "v.word", "v.num")


@query
def variant_rows(spark, folder):
    return variants_of(explode_tokens(conversation_lines(spark, folder), "line", token="word"))


@query
def variant_counts(spark, folder):
    variants = variants_of(document_words(spark, folder).select("word"))
    return variants.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def variant_running_totals(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    totals = listed.running_item_counts(
        documents, "doc_id", lines_of(F.col("text")), tokens_of, lambda word: word.startswith(PREFIX)
    )
    shown = F.concat(F.lit("match:"), F.col("matches").cast("string"), F.lit(",noMatch:"), F.col("others").cast("string"))
    return totals.select("doc_id", F.col("list_no").alias("line_no"), "pos", shown.alias("totals"))


@query
def split_select(spark, folder):
    even = F.col("event_id") % 2 == 0
    tagged = transforms.tag_rows(table(spark, folder, "events").select("event_id"), even=even, odd=~even)
    chosen = {"even": ["even"], "odd": ["odd"], "both": ["even", "odd"]}
    selected = [
        transforms.select_tagged(tagged, *tags).select("event_id", F.lit(name).alias("selection"))
        for name, tags in chosen.items()
    ]
    return compose.union(*selected)


@query
def iterate_countdown(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("v"))
    return iterate(
        parts,
        step=lambda row: F.struct(row["p_partkey"].alias("p_partkey"), (row["v"] - 1).alias("v")),
        output=lambda row: row["v"] > 0,
        feedback=lambda row: row["v"] > 1,
        max_iterations=1_000,
    )


# Keys, partitions, several inputs


@query
def keyed_running_sum(spark, folder):
    events = events_of(spark, folder).select("event_id", "user_id", "cents")
    return rolling.running_sum(events, "user_id", "event_id", "cents").drop("cents")


@query
def custom_partition(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id")
    tasks_each = max(1, spark.sparkContext.defaultParallelism // 4)
    placed = compose.partition_custom(events, 4, F.col("user_id") % 4, tasks_each)
    return placed.select("event_id", compose.partition_number(tasks_each).alias("partition"))


@query
def sorted_partitions(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    placed = compose.partition_custom(events, 4, F.col("user_id") % 4)
    ordered = compose.sort_partitions(placed, F.desc("event_type"), "event_id", position="position")
    return ordered.select("event_id", "event_type", compose.partition_number().alias("partition"), "position")


@query
def keyed_parallelism(spark, folder):
    # The rows of a user are on one of the seven partitions.
    events = table(spark, folder, "events").select("event_id", "user_id")
    spread = compose.set_parallelism(events, 7, "user_id").select("user_id", F.spark_partition_id().alias("partition"))
    return spread.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("partition").alias("partitions"),
        F.max(F.when(F.col("partition").between(0, 6), 0).otherwise(1)).alias("outside"),
    )


@query
def union_streams(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    clicks, purchases = of_type(events, "click"), of_type(events, "purchase")
    return compose.union(clicks, purchases, clicks)


@query
def co_map(spark, folder):
    events, turns = table(spark, folder, "events"), table(spark, folder, "conversations")
    return compose.connect(
        events, turns,
        lambda left: left.select(F.col("event_id").cast("string").alias("value")),
        lambda right: right.select(F.col("text").alias("value")),
    )


@query
def co_flat_map(spark, folder):
    events, lines = table(spark, folder, "events"), conversation_lines(spark, folder)
    return compose.connect(
        events, lines,
        lambda left: left.select(F.col("event_id").cast("string").alias("value")),
        lambda right: right.select(F.explode(tokens_of(F.col("line"))).alias("value")),
    )


def user_time_text(events: DataFrame) -> DataFrame:
    return events.select(F.format_string("CoUserTime(%d,%d)", "user_id", "time").alias("value"))


@query
def co_process(spark, folder):
    events = events_of(spark, folder)
    return compose.connect(of_type(events, "click"), of_type(events, "purchase"), user_time_text, user_time_text)


def priorities(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("name"), "o_orderkey")


@query
def broadcast_enrich(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id")
    return enrich.broadcast_enrich(events, priorities(spark, folder), "user_id", "name", "o_orderkey")


@query
def keyed_broadcast_enrich(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    enriched = enrich.broadcast_enrich(events, priorities(spark, folder), "user_id", "name", "o_orderkey")
    return enriched.select(
        "event_id", "event_type", enrich.keyed_value_text(F.col("name"), F.col("user_id")).alias("described")
    )


@query
def broadcast_enrich_asof(spark, folder):
    events = table(spark, folder, "events")
    config = of_type(events, "signup").select("event_id", "user_id", F.col("props").alias("name"))
    asked = of_type(events, "purchase").select("event_id", "user_id")
    return enrich.enrich_as_of(asked, config, "user_id", "name", "event_id")


# Joins


def clicks_and_purchases(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with times cut to the minute, so that distances can equal the bounds."""
    minute = F.floor(F.col("time") / MINUTE) * MINUTE
    left = of_type(events, "click").select("user_id", F.col("event_id").alias("left_id"), minute.alias("left_time"))
    right = of_type(events, "purchase").select("user_id", F.col("event_id").alias("right_id"), minute.alias("right_time"))
    return left, right


def _within_six_hours(spark, folder, inclusive):
    left, right = clicks_and_purchases(events_of(spark, folder))
    joined = join_within(left, right, "user_id", "left_time", "right_time", -6 * HOUR, 6 * HOUR, inclusive)
    return joined.select("user_id", "left_id", "right_id")


@query
def interval_join(spark, folder):
    return _within_six_hours(spark, folder, False)


@query
def interval_join_inclusive(spark, folder):
    return _within_six_hours(spark, folder, True)


def session_sides(spark, folder) -> dict:
    events = events_of(spark, folder).select("event_id", "user_id", "event_type", "time")
    return {
        "left": of_type(events, "click"),
        "right": of_type(events, "purchase"),
        "keys": "user_id",
        "time": "time",
        "gap": 24 * HOUR,
        "order_by": "event_id",
    }


def _pair_columns():
    text = F.format_string("%d == %d", F.col("left.user_id"), F.col("right.user_id"))
    ids = [F.col("left.event_id").alias("left_id"), F.col("right.event_id").alias("right_id")]
    return ["user_id", "session_start", *ids, text.alias("text")]


@query
def session_join(spark, folder):
    return sessions.session_join(**session_sides(spark, folder)).select(*_pair_columns())


@query
def session_join_per_element(spark, folder):
    return sessions.session_join_per_element(**session_sides(spark, folder)).select(*_pair_columns(), "arrival")


def _group_text():
    return sessions.cogroup_text(F.col("user_id"), F.lit(1), F.col("n_left"), F.col("n_right")).alias("text")


@query
def session_cogroup(spark, folder):
    groups = sessions.session_cogroup(**session_sides(spark, folder))
    return groups.select("user_id", "session_start", "n_left", "n_right", _group_text())


@query
def session_cogroup_per_element(spark, folder):
    groups = sessions.session_cogroup_per_element(**session_sides(spark, folder))
    return groups.select("event_id", "user_id", "session_start", "n_left", "n_right")


# Aggregations


@query
def word_count(spark, folder):
    return document_words(spark, folder).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query
def keyed_running_max_by(spark, folder):
    # Scores are coarse, so that a user's largest score comes up more than once.
    events = events_of(spark, folder).select("event_id", "user_id", F.expr("cents div 1000").alias("score"))
    best = rolling.running_max_by(events, "user_id", "event_id", "score")
    return best.select(
        "event_id", "user_id", F.col("max_row.event_id").alias("max_event_id"), F.col("max_row.score").alias("max_score")
    )


@query
def accumulator_count(spark, folder):
    lines = conversation_lines(spark, folder).select("line")
    words = transforms.rich_flat_map(lines, SplitWords, "word string, num int")
    watched, counter = transforms.counted(words, "words")
    watched.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(counter.get["words"],)], "words bigint")


class Spread(Aggregate):
    """Number, total, average towards zero, and distance of the smallest and largest of a column."""

    schema = "n bigint, total bigint, average bigint, width bigint"

    def create(self):
        return 0, 0, None, None

    def add(self, accumulator, rows):
        values = rows.column("cents").drop_null().to_numpy(zero_copy_only=False)
        if not len(values):
            return accumulator
        return self.merge(accumulator, (len(values), int(values.sum()), int(values.min()), int(values.max())))

    def merge(self, one, other):
        known = [a for a in (one, other) if a[0]]
        if len(known) < 2:
            return known[0] if known else one
        (n, total, low, high), (m, more, lower, higher) = known
        return n + m, total + more, min(low, lower), max(high, higher)

    def result(self, accumulator):
        n, total, low, high = accumulator
        return (n, total, abs(total) // n * (1 if total >= 0 else -1), high - low) if n else (0, 0, None, None)


@query
def mergeable_aggregate(spark, folder):
    return aggregate_by(events_of(spark, folder).select("event_type", "cents"), "event_type", Spread())


# Count windows


def window_input(spark, folder):
    return events_of(spark, folder).select("event_id", "user_id", "event_type", "cents")


@query
def count_window_reduce(spark, folder):
    reduced = count_windows.count_window_reduce(
        window_input(spark, folder), "user_id", "event_id", 2,
        lambda a, b: F.struct(
            a["event_id"].alias("event_id"),
            a["user_id"].alias("user_id"),
            F.concat(a["event_type"], b["event_type"]).alias("event_type"),
            (a["cents"] + b["cents"]).alias("cents"),
        ),
    )
    return reduced.select(
        "user_id", "window_no", F.col("result.event_id").alias("first_id"),
        F.col("result.event_type").alias("names"), F.col("result.cents").alias("total"),
    )


@query
def count_window_aggregate(spark, folder):
    folded = count_windows.count_window_aggregate(
        window_input(spark, folder), "user_id", "event_id", 5,
        zero=F.struct(F.lit("").alias("names"), F.lit(0).cast("bigint").alias("total")),
        add=lambda acc, row: F.struct(
            F.concat(row["event_type"], F.lit("\t"), acc["names"]).alias("names"),
            (acc["total"] + row["cents"]).alias("total"),
        ),
    )
    return folded.select("user_id", "window_no", "result.names", "result.total")


@query
def count_window_avg(spark, folder):
    windows = count_windows.count_window_agg(
        window_input(spark, folder), "user_id", "event_id", 5,
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"),
    )
    return windows.select("user_id", "window_no", "n", F.expr("total div n").alias("average"))


@query
def count_window_process(spark, folder):
    size = 5

    def spread(windows: pa.RecordBatch) -> pa.RecordBatch:
        cents = windows.column("rows").flatten().field("cents").to_numpy(zero_copy_only=False)
        totals = cents.reshape(-1, size).sum(1)
        averages = np.sign(totals) * (np.abs(totals) // size)  # towards zero
        columns = [windows.column("user_id"), windows.column("window_no"), pa.array(np.full(len(totals), size)), pa.array(averages)]
        return pa.RecordBatch.from_arrays(columns, names=["user_id", "window_no", "n", "average"])

    return count_windows.count_window_process(
        window_input(spark, folder), "user_id", "event_id", size, spread,
        "user_id bigint, window_no bigint, n bigint, average bigint",
    )


@query
def count_window_all_reduce(spark, folder):
    events = events_of(spark, folder).select("event_id", "event_type", "cents")
    reduced = count_windows.count_window_reduce(
        events, None, "event_id", 4,
        lambda a, b: F.struct(
            a["event_id"].alias("event_id"),
            F.concat(a["event_type"], b["event_type"]).alias("event_type"),
            (a["cents"] + b["cents"]).alias("cents"),
        ),
    )
    return reduced.select(
        "window_no", F.col("result.event_id").alias("first_id"),
        F.col("result.event_type").alias("names"), F.col("result.cents").alias("total"),
    )


# Regrouping and output


@query
def group_sorted_concat(spark, folder):
    orders = table(spark, folder, "orders")
    path = work_dir(spark, "pairs")
    write_lines(orders.select(F.concat_ws("\t", "o_orderkey", "o_custkey").alias("value")), path)
    pairs = regroup.parse_pairs(read_lines(spark, path), "line")
    return regroup.regroup_sorted(pairs, max_values=PART_ITEMS).select("key", "part", "first", "line")


@query
def text_roundtrip(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path = work_dir(spark, "lines")
    lines = explode_lines(documents, "text")
    write_lines(lines.select(F.concat_ws("\t", "doc_id", "line_no", "line").alias("value")), path)
    fields = F.split("line", "\t", 3)
    return read_lines(spark, path).select(
        fields[0].cast("bigint").alias("doc_id"), fields[1].cast("int").alias("line_no"), fields[2].alias("line")
    )


@query
def custom_writer_roundtrip(spark, folder):
    spark.dataSource.register(LineSink)
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    path = qualified(spark, work_dir(spark, "records"))
    events.write.format("lines").mode("append").save(path)
    fields = F.split("line", "\t")
    return read_lines(spark, path).select(
        fields[0].cast("bigint").alias("event_id"), fields[1].cast("bigint").alias("user_id"), fields[2].alias("event_type")
    )


@query
def labelled_output(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    return transforms.labelled(events, "events", ["event_type", "event_id"]).select("line")


# Timers, segments, state


@query
def idle_timeout_count(spark, folder):
    events = events_of(spark, folder).select("event_id", "user_id", "time")
    return timeouts.idle_timeout_count(events, "user_id", "time", 6 * HOUR, "event_id")


@query
def timer_echo(spark, folder):
    return timeouts.timer_echo(events_of(spark, folder), "user_id", "time", 6 * HOUR)


@query
def marker_segments(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return segments.marker_segments(events, "user_id", "event_id", "event_type", "error", max_items=PART_ITEMS)


@query
def marker_segments_global(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    return segments.marker_segments(events, None, "event_id", "event_type", "error", max_items=PART_ITEMS)


@query
def last_value_state(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return rolling.last_value(events, "user_id", "event_id", "event_type")


@query
def poison_quarantine(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    marked = transforms.quarantine(events, F.col("event_type") == "error")
    return marked.select("event_id", F.col("quarantined").cast("int").alias("quarantined"))
