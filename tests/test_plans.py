"""Plans stay as they are meant to be."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_points


def plan_of(frame) -> str:
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        frame.explain("formatted")
    return shown.getvalue()


@pytest.fixture
def plan(spark, sf_dir):
    return lambda name: plan_of(entry_points.queries()[name](spark, sf_dir))


KEYED = ["keyed_running_sum", "keyed_running_max_by", "last_value_state", "idle_timeout_count", "marker_segments",
         "count_window_reduce", "count_window_avg", "session_cogroup_per_element", "broadcast_enrich_asof"]


@pytest.mark.parametrize("name", KEYED)
def test_one_shuffle_by_key(plan, name):
    text = plan(name)
    shuffles = re.findall(r"^\(\d+\) Exchange$", text, re.M)
    assert len(shuffles) == 1, text


def test_filters_and_columns_reach_the_scan(plan):
    text = plan("filter_rows")
    assert "GreaterThan(value,50.0)" in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan("tokenize")
    assert "EqualTo(event_type,click)" in plan("union_streams")


def test_no_python_and_no_cross_joins_in_batch_operators(plan):
    for name in [*KEYED, "session_join", "session_cogroup", "interval_join", "word_count", "variant_running_totals"]:
        text = plan(name)
        assert not re.search(r"InPandas|ArrowEvalPython|MapInArrow|CartesianProduct|NestedLoop", text), name


def test_word_count_combines_before_the_shuffle(plan):
    text = plan("word_count")
    assert text.index("partial_count") < text.index("Exchange", text.index("partial_count"))


SLICED = {
    "keyed_running_sum": 2, "idle_timeout_count": 2, "marker_segments": 2, "marker_segments_global": 2, "session_cogroup": 2,
    "session_cogroup_per_element": 2, "broadcast_enrich_asof": 2, "count_window_all_reduce": 2, "session_join_per_element": 4,
}


@pytest.mark.parametrize("name", list(SLICED))
def test_sliced_plans_read_rows_and_carries_once(plan, monkeypatch, name):
    """The rows with their values inside slices, and what is carried; a join of two sides reads them for each."""
    from keyrill.plans import slices

    monkeypatch.setattr(slices, "ROWS_PER_SLICE", 30)
    text = plan(name)
    scans = re.findall(r"^\(\d+\) Scan parquet", text, re.M)
    assert len(scans) == SLICED[name] and "_c_" in text, text


def frames_to_the_end(text: str) -> list[str]:
    """Window frames that end with the key but do not begin with it."""
    assert "unboundedpreceding" in text, text
    return re.findall(r"specifiedwindowframe\(\w+, (?!unboundedpreceding)\S+, unboundedfollowing", text)


@pytest.mark.parametrize("key", [None, "user_id"])
def test_segments_have_no_frame_that_is_gone_over_for_each_row(spark, key):
    """A frame from a row to the end of the key costs the square of the key's rows."""
    from keyrill.operators.segments import marker_segments

    events = spark.createDataFrame([(1, 1, "a"), (2, 1, "error"), (3, 1, "a")], "event_id long, user_id long, event_type string")
    assert not frames_to_the_end(plan_of(marker_segments(events, key, "event_id", "event_type", "error")))


def test_segments_of_a_stream_have_no_frame_that_is_gone_over_for_each_row(spark, tmp_path, monkeypatch):
    from keyrill.streaming import overall

    plans, segments = [], overall.marker_segments

    def noted(*args):
        plans.append(plan_of(found := segments(*args)))
        return found

    monkeypatch.setattr(overall, "marker_segments", noted)
    store = overall.segments_all(str(tmp_path), "event_id", "event_type", "error", 2)
    kinds = ["a", "error", "b", "c", "d", "error", "e"]
    for number, at in enumerate([0, 4]):  # the second segment spans both batches
        batch = spark.createDataFrame(list(enumerate(kinds))[at : at + 4], "event_id long, event_type string")
        store(batch, number)
    assert len(plans) == 2 and not any(map(frames_to_the_end, plans))
    found = spark.read.parquet(f"{tmp_path}/out").select("segment", "part", "size", "text").collect()
    assert sorted(map(tuple, found)) == [(0, 0, 1, " a"), (1, 0, 2, " b c"), (1, 1, 1, " d")]
