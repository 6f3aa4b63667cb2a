"""Small inputs with results worked out by hand."""

from pyspark.sql import functions as F

from keyrill.functions.text import explode_lines, explode_tokens, tokens_of, word_variants
from keyrill.operators import compose, count_windows, enrich, regroup, rolling, segments, sessions, timeouts, transforms
from keyrill.operators.interval import interval_join
from keyrill.operators.iterate import iterate
from keyrill.sources.collections import rows, sequence

import pytest

SCORES = "seq int, school string, class string, name string, score int"


def scores(spark, *entries):
    return rows(spark, [(i, "s", *entry) for i, entry in enumerate(entries)], SCORES)


F1A = [("c12", "A", 50), ("c12", "B", 55), ("c11", "C", 50), ("c11", "D", 45)]
F1C = [("c12", "A", 50), ("c11", "C", 50), ("c12", "B", 55)]


def found(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_running_max_by_keeps_the_first_of_equals(spark):
    best = rolling.running_max_by(scores(spark, *F1A, ("c11", "E", 50)), "class", "seq", "score")
    assert found(best, "seq", "max_row.name", "max_row.score") == [
        (0, "A", 50), (1, "B", 55), (2, "C", 50), (3, "C", 50), (4, "C", 50)
    ]


@pytest.mark.parametrize("kind", ["int", "double", "decimal(9,2)", "string", "date", "timestamp", "boolean"])
def test_running_max_by_orders_every_kind(spark, kind):
    texts = {
        "int": ["-5", "3", "3", "-2147483648", "2147483647"],
        "double": ["-5.5", "0.1", "NaN", "2.5", "NaN"],
        "decimal(9,2)": ["-5.50", "0.10", "0.05", "2.50", "2.50"],
        "string": ["b", "a", "ba", "é", "b"],
        "date": ["2024-01-02", "2024-01-01", "1969-05-05", "2024-01-02", "2025-01-01"],
        "timestamp": ["2024-01-02 00:00:01", "2024-01-01 00:00:00", "1969-05-05 00:00:00", "2024-01-02 00:00:01", "2025-01-01 00:00:00"],
        "boolean": ["false", "true", "false", "true", "true"],
    }[kind]
    frame = rows(spark, list(enumerate(texts)), "seq int, t string").select("seq", F.col("t").cast(kind).alias("v"))
    best = found(rolling.running_max_by(frame, None, "seq", "v"), "seq", "max_row.seq")
    values = [row["v"] for row in frame.orderBy("seq").collect()]
    key = (lambda v: (v != v, 0 if v != v else v)) if kind == "double" else (lambda v: v.encode() if kind == "string" else v)
    expected = [(i, max(range(i + 1), key=lambda j: (key(values[j]), -j))) for i in range(5)]
    assert best == expected


def test_project_positions(spark):
    assert found(transforms.project(scores(spark, *F1A), 2, 3), "class", "name")[0] == ("c11", "C")


def test_custom_partition(spark):
    placed = compose.partition_custom(scores(spark, *F1A), 3, F.lit(1))
    assert {r[0] for r in placed.select(F.spark_partition_id()).collect()} == {1}
    with pytest.raises(Exception, match="partition out of 0..2: 7"):
        compose.partition_custom(scores(spark, *F1A), 3, F.lit(7)).collect()


def test_count_windows(spark):
    reduced = count_windows.count_window_reduce(
        scores(spark, *F1A[:3]), "class", "seq", 2,
        lambda a, b: F.struct(
            a["seq"].alias("seq"), a["school"].alias("school"), a["class"].alias("class"),
            F.concat(a["name"], b["name"]).alias("name"), (a["score"] + b["score"]).alias("score"),
        ),
    )
    assert found(reduced, "result.school", "result.class", "result.name", "result.score") == [("s", "c12", "AB", 105)]

    folded = count_windows.count_window_aggregate(
        scores(spark, *F1C), "class", "seq", 2,
        zero=F.struct(F.lit("").alias("n"), F.lit(0).cast("bigint").alias("t")),
        add=lambda acc, row: F.struct(F.concat(row["name"], F.lit("\t"), acc["n"]).alias("n"), (acc["t"] + row["score"]).alias("t")),
    )
    assert found(folded, "result.n", "result.t") == [("B\tA\t", 105)]

    average = count_windows.count_window_agg(
        scores(spark, *F1C), "class", "seq", 2, F.count(F.lit(1)).alias("n"), F.expr("sum(score) div count(1)").alias("avg")
    )
    assert found(average, "n", "avg") == [(2, 52)]

    overall = count_windows.count_window_agg(
        scores(spark, *F1C, F1A[3]), None, "seq", 2, F.min_by("name", "seq").alias("first"), F.sum("score").alias("t")
    )
    assert found(overall, "first", "t") == [("A", 100), ("B", 100)]


def countdown(frame, limit=100, feedback=lambda row: row["v"] > 1):
    return iterate(
        frame, step=lambda row: F.struct((row["v"] - 1).alias("v")), output=lambda row: row["v"] > 0,
        feedback=feedback, max_iterations=limit, rounds_per_job=4,
    )


def test_iteration(spark):
    numbers = sequence(spark, 0, 10)
    assert found(countdown(numbers), "v") == sorted((v,) for v in range(1, 11) for _ in range(11 - v))
    with pytest.raises(RuntimeError, match="in flight after 20"):
        countdown(numbers, 20, lambda row: F.lit(True))


def test_split_and_select(spark):
    tagged = transforms.tag_rows(sequence(spark, 0, 10), even=F.col("v") % 2 == 0, odd=F.col("v") % 2 == 1)
    assert found(transforms.select_tagged(tagged, "even"), "v") == [(v,) for v in range(0, 11, 2)]
    assert found(transforms.select_tagged(tagged, "even", "odd"), "v") == [(v,) for v in range(11)]


def test_connected_streams(spark):
    numbers, lines = sequence(spark, 0, 10), rows(spark, [("one two three",)], "line string")
    text = lambda left: left.select(F.col("v").cast("string").alias("x"))
    mapped = compose.connect(numbers, lines, text, lambda right: right.select(F.col("line").alias("x")))
    assert mapped.count() == 12
    split = compose.connect(numbers, lines, text, lambda right: right.select(F.explode(tokens_of(F.col("line"))).alias("x")))
    assert split.count() == 14
    assert compose.union(numbers, sequence(spark, 11, 20), sequence(spark, 21, 30)).count() == 31


def test_tokens(spark):
    lines = rows(spark, [("a  b  ",), ("",), ("  ",), (" a",)], "line string")
    tokens = {r["line"]: r["t"] for r in lines.select("line", tokens_of(F.col("line")).alias("t")).collect()}
    assert tokens == {"a  b  ": ["a", "", "b"], "": [""], "  ": [], " a": ["", "a"]}


def test_lines(spark):
    text = rows(spark, [("a\r\nb\n\nc\n",)], "text string")
    assert found(explode_lines(text, "text"), "line_no", "line") == [(0, "a"), (1, "b"), (2, ""), (3, "c")]


def test_running_word_count(spark):
    lines = rows(spark, [(0, "a a a"), (1, "b b b")], "at int, line string")
    words = explode_tokens(lines, "line", token="word").withColumn("one", F.lit(1))
    sums = rolling.running_sum(words, "word", ["at", "pos"], "one")
    assert found(sums, "word", "running_sum") == [(w, i) for w in "ab" for i in (1, 2, 3)]
    watched, counter = transforms.counted(words)
    watched.collect()
    assert counter.get["rows"] == 6


def test_variants(spark):
    words = explode_tokens(rows(spark, [("seen1 x seen",)], "line string"), "line", token="word")
    kinds = words.select("pos", F.explode(word_variants(F.col("word"), "seen")).alias("v")).select("pos", "v.*")
    assert found(kinds.filter("kind = 'count'"), "word", "num") == [("seen", 1), ("seen1", 1), ("x", 1)]
    totals = rolling.running_counts(
        kinds.filter("kind <> 'count'"), "pos", matches=F.col("kind") == "match", others=F.col("kind") == "no_match"
    )
    assert found(totals, "pos", "matches", "others") == [(0, 1, 0), (1, 1, 1), (2, 2, 1)]


def test_interval_bounds(spark):
    left = rows(spark, [("k", 1, 1000)], "k string, a int, t long")
    right = rows(spark, [("k", i, 1000 + d) for i, d in enumerate([0, 19, 20, -20, 21, -21])] + [("z", 9, 1000)], "k string, b int, u long")
    assert found(interval_join(left, right, "k", "t", "u", -20, 20, inclusive=False), "k", "b") == [("k", 0), ("k", 1)]
    assert found(interval_join(left, right, "k", "t", "u", -20, 20), "b") == [(0,), (1,), (2,), (3,)]
    stamp = lambda df, c: df.withColumn(c, F.timestamp_millis(c))
    timed = interval_join(stamp(left, "t"), stamp(right, "u"), "k", "t", "u", -20, 20)
    assert found(timed, "b") == [(0,), (1,), (2,), (3,)]


def test_idle_timeout_and_echo(spark):
    users = rows(
        spark, [("a", 1000), ("a", 2000), ("b", 2500), ("b", 5500), ("b", 5501), ("c", 8501), ("c", 60000)], "user string, time long"
    )
    counted = timeouts.idle_timeout_count(users, "user", "time", 3000, [])
    assert found(counted, "user", "count") == [("a", 2), ("b", 3), ("c", 1), ("c", 2)]
    echoed = timeouts.timer_echo(users.unionByName(users.limit(1)), "user", "time", 3000)
    assert echoed.count() == 7


SIDES = {"keys": "word", "time": "t", "gap": 10_000, "order_by": "seq"}


@pytest.fixture
def sides(spark):
    schema = "seq int, word string, t long"
    left = rows(spark, [(0, "x", 0), (2, "x", 20_000), (3, "x", 30_001)], schema)
    right = rows(spark, [(1, "x", 10_000), (4, "y", 0)], schema)
    return left, right


def test_sessions(sides):
    joined = sessions.session_join(*sides, **SIDES)
    assert found(joined, "word", "left.seq", "right.seq") == [("x", 0, 1), ("x", 2, 1)]
    emitted = sessions.session_join_per_element(*sides, **SIDES)
    assert found(emitted, "left.seq", "right.seq", "arrival") == [(0, 1, 2), (2, 1, 3)]
    grouped = sessions.session_cogroup(*sides, **SIDES)
    assert found(grouped, "word", "n_left", "n_right") == [("x", 1, 0), ("x", 2, 1), ("y", 0, 1)]
    arrivals = sessions.session_cogroup_per_element(*sides, **SIDES)
    assert found(arrivals, "seq", "n_left", "n_right") == [(0, 1, 0), (1, 1, 1), (2, 2, 1), (3, 1, 0), (4, 0, 1)]


def test_cogroup_text(sides):
    shown = sessions.session_cogroup(*sides, **SIDES).select(
        sessions.cogroup_text(F.col("word"), F.lit(1), F.col("n_left"), F.col("n_right")).alias("text")
    )
    assert ("Data in stream1: \nx<->1\nx<->1\nData in stream2: \nx<->1\n",) in found(shown, "text")


def test_segments(spark):
    items = "| a a a a a f d d | ad d s s d |".split() + ["tail"]
    frame = rows(spark, list(enumerate(items)), "seq long, item string")
    closed = segments.marker_segments(frame, None, "seq", "item", "|")
    assert found(closed, "size", "text") == [(5, " ad d s s d"), (8, " a a a a a f d d")]


def test_poison(spark):
    frame = rows(spark, [("k", 666), ("k", 888)], "key string, v int")
    with pytest.raises(Exception, match="poison record"):
        transforms.fail_on(frame, F.col("v") == 888).collect()
    assert found(transforms.fail_on(frame, F.col("v") == 1), "v") == [(666,), (888,)]
    marked = transforms.quarantine(frame, F.col("v") == 888)
    assert found(marked, "v", "quarantined") == [(666, False), (888, True)]


def test_config_lookup(spark):
    config = rows(spark, [(0, "CN", "old"), (1, "CN", "China"), (5, "US", "late")], "seq int, code string, name string")
    events = rows(spark, [(2, "CN"), (3, "US"), (4, "FR")], "seq int, code string")
    final = enrich.broadcast_enrich(events, config, "code", "name", "seq")
    described = final.select("code", enrich.keyed_value_text(F.col("name"), F.col("code")).alias("d"))
    assert found(described, "code", "d") == [("CN", "China,key:CN"), ("US", "late,key:US")]
    assert found(enrich.enrich_as_of(events, config, "code", "name", "seq"), "seq", "name") == [(2, "China")]


def test_regroup(spark):
    lines = rows(spark, [("3\tA",), ("9\tC",), ("1\tA",), ("10\tB",), ("3\tA",)], "value string")
    grouped = regroup.regroup_sorted(regroup.parse_pairs(lines))
    assert [r["line"] for r in grouped.collect()] == ["A\t1\t3\t3", "B\t10", "C\t9"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        regroup.parse_pairs(rows(spark, [("x\tA",)], "value string")).collect()


def test_labelled_output(spark):
    assert found(transforms.labelled(rows(spark, [("a", None)], "w string, n int"), "out", ["w", "n"]), "line") == [("out> (a,null)",)]


def test_keys_by_name_position_and_expression(spark):
    for keys in ["class", 2, F.upper("class"), ["school", "class"], [1, F.col("class")]]:
        sums = rolling.running_sum(scores(spark, *F1A), keys, "seq", "score")
        assert found(sums, "seq", "running_sum") == [(0, 50), (1, 105), (2, 50), (3, 95)]


def test_arrival_stamp(spark):
    stamped = transforms.stamp_arrival(scores(spark, *F1A))
    assert stamped.first()["arrived"] > 1_700_000_000_000


def test_parallelism(spark):
    assert compose.set_parallelism(scores(spark, *F1A), 3, "class").select(F.spark_partition_id()).distinct().count() <= 3


def test_client_side_rows(spark):
    assert sum(r["v"] for r in sequence(spark, 1, 100).toLocalIterator(prefetchPartitions=True)) == 5050
