"""Hot keys split into slices give the rows of a plain loop over each key."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keyrill.operators import count_windows, enrich, regroup, rolling, segments, sessions, timeouts
from keyrill.plans.slices import MAX_CARRY_ROWS, SLICE, plan_slices
from keyrill.sources.collections import rows

PER_SLICE = 40


@pytest.fixture(scope="module")
def data():
    """A third of the rows under one key, some under no key, and bunched times."""
    rng = random.Random(7)
    entries, time = [], 0
    for seq in range(900):
        time += rng.choice([0, 1, 3, 9, 30])
        key = "hot" if rng.random() < 0.4 else rng.choice([None, "a", "b", *"cdefgh"])
        value = rng.choice([None, *range(6)])
        entries.append((seq, time, key, value, rng.choice(["x", "y", "|", "z"]), rng.choice(["left", "right"])))
    rng.shuffle(entries)
    return entries


@pytest.fixture(scope="module")
def frame(spark, data):
    return rows(spark, data, "seq long, time long, k string, v int, item string, side string")


def by_key(data):
    groups = defaultdict(list)
    for entry in sorted(data):
        groups[entry[2]].append(entry)
    return groups


def found(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def same(frame, columns, expected):
    assert found(frame, *columns) == sorted(expected, key=repr)


def test_slices_are_ordered_and_level(frame, data):
    plan = plan_slices(frame, "k", "seq", PER_SLICE)
    assert plan.sliced and plan.pairs <= MAX_CARRY_ROWS
    placed = plan.assign(frame).filter(f"{SLICE}.l0 >= 0").groupBy("k", SLICE)
    assert placed.count().count() <= plan.pairs
    sizes = placed.agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("k", SLICE).collect()
    hot = [r for r in sizes if r["k"] == "hot"]
    assert len(hot) > 5 and max(r["n"] for r in hot) <= 2 * PER_SLICE
    assert all(a["hi"] < b["lo"] for a, b in zip(hot, hot[1:]))


def test_small_input_is_not_sliced(frame):
    assert not plan_slices(frame, "k", "seq").sliced


def test_running_sum(frame, data):
    expected = []
    for entries in by_key(data).values():
        total = None
        for seq, _, _, value, *_ in entries:
            total = total if value is None else (total or 0) + value
            expected.append((seq, total))
    same(rolling.running_sum(frame, "k", "seq", "v", rows_per_slice=PER_SLICE), ["seq", "running_sum"], expected)


def test_running_max_by(frame, data):
    expected = []
    for entries in by_key(data).values():
        best = None
        for e in entries:
            if best is None or (e[3] is not None and (best[3] is None or e[3] > best[3])):
                best = e
            expected.append((e[0], best[0]))
    same(rolling.running_max_by(frame, "k", "seq", "v", rows_per_slice=PER_SLICE), ["seq", "max_row.seq"], expected)


def test_last_value(frame, data):
    expected = []
    for entries in by_key(data).values():
        expected += [(e[0], before[3] if before else None) for before, e in zip([None, *entries], entries)]
    same(rolling.last_value(frame, "k", "seq", "v", rows_per_slice=PER_SLICE), ["seq", "previous"], expected)


def test_global_totals(frame, data):
    expected, left, right = [], 0, 0
    for e in sorted(data):
        left, right = left + (e[5] == "left"), right + (e[5] == "right")
        expected.append((e[0], left, right))
    totals = rolling.running_counts(
        frame, "seq", rows_per_slice=PER_SLICE, a=F.col("side") == "left", b=F.col("side") == "right"
    )
    same(totals, ["seq", "a", "b"], expected)


@pytest.mark.parametrize("keys", ["k", None])
def test_count_windows(frame, data, keys):
    groups = by_key(data) if keys else {"": sorted(data)}
    expected = [
        (i // 7, [e[0] for e in entries[i : i + 7]])
        for entries in groups.values()
        for i in range(0, len(entries) - 6, 7)
    ]
    windows = count_windows.count_window_rows(frame, keys, "seq", 7, rows_per_slice=PER_SLICE)
    same(windows, ["window_no", "rows.seq"], expected)


def brute_sessions(data, gap):
    for entries in by_key(data).values():
        session, last = [], None
        for e in entries:
            if last is not None and e[1] - last > gap:
                yield session
                session = []
            session.append(e)
            last = e[1]
        yield session


GAP = 12


@pytest.fixture
def sides(frame):
    known = frame.filter(F.col("k").isNotNull())
    return known.filter("side = 'left'").drop("side"), known.filter("side = 'right'").drop("side")


OPTIONS = {"keys": "k", "time": "time", "gap": GAP, "order_by": "seq", "rows_per_slice": PER_SLICE}


def test_sessionize(frame, data):
    expected = [(e[0], s[0][1]) for s in brute_sessions(data, GAP) for e in s]
    same(sessions.sessionize(frame, "k", "time", GAP, "seq", PER_SLICE), ["seq", "session_start"], expected)


def known_sessions(data):
    return [s for s in brute_sessions(data, GAP) if s and s[0][2] is not None]


def test_session_join(sides, data):
    expected = [
        (a[0], b[0]) for s in known_sessions(data) for a in s if a[5] == "left" for b in s if b[5] == "right"
    ]
    same(sessions.session_join(*sides, **OPTIONS), ["left.seq", "right.seq"], expected)


def test_session_join_per_element(sides, data):
    expected = []
    for s in known_sessions(data):
        for i, new in enumerate(s):
            expected += [tuple(e[0] for e in sorted((new, old), key=lambda e: e[5])) for old in s[:i] if old[5] != new[5]]
    same(sessions.session_join_per_element(*sides, **OPTIONS), ["left.seq", "right.seq"], expected)


def test_session_cogroup(sides, data):
    expected, arrivals = [], []
    for s in known_sessions(data):
        n_left = n_right = 0
        for e in s:
            n_left, n_right = n_left + (e[5] == "left"), n_right + (e[5] == "right")
            arrivals.append((e[0], n_left, n_right))
        expected.append((s[0][2], s[0][1], n_left, n_right))
    same(sessions.session_cogroup(*sides, **OPTIONS), ["k", "session_start", "n_left", "n_right"], expected)
    same(sessions.session_cogroup_per_element(*sides, **OPTIONS), ["seq", "n_left", "n_right"], arrivals)


def test_idle_timeout(frame, data):
    expected = []
    for key, entries in by_key(data).items():
        for i, e in enumerate(entries):
            if i + 1 == len(entries) or entries[i + 1][1] - e[1] > 9:
                expected.append((key, e[1], i + 1))
    same(timeouts.idle_timeout_count(frame, "k", "time", 9, "seq", PER_SLICE), ["k", "time", "count"], expected)


@pytest.mark.parametrize("keys", ["k", None])
def test_segments(frame, data, keys):
    groups = by_key(data) if keys else {"": sorted(data)}
    expected = []
    for entries in groups.values():
        run = []
        for e in entries:
            if e[4] == "|":
                if run:
                    expected.append((len(run), "".join(f" {i}" for i in run)))
                run = []
            else:
                run.append(e[4])
    same(segments.marker_segments(frame, keys, "seq", "item", "|", PER_SLICE), ["size", "text"], expected)


def test_long_segments_come_in_parts(spark):
    items = [(i, str(i)) for i in range(500)] + [(500, "|")]
    frame = rows(spark, items, "seq long, item string")
    parts = segments.marker_segments(frame, None, "seq", "item", "|", PER_SLICE, max_items=100).orderBy("part").collect()
    assert [p["size"] for p in parts] == [100] * 5
    assert "".join(p["text"] for p in parts) == "".join(f" {i}" for i in range(500))


def test_as_of(frame, data):
    config = frame.filter("item = '|'").select("seq", "k", F.col("time").alias("told"))
    events = frame.filter("item = 'x'").select("seq", "k")
    expected = []
    for entries in by_key(data).values():
        known = None
        for e in entries:
            if e[4] == "|":
                known = e[1]
            elif e[4] == "x" and known is not None:
                expected.append((e[0], known))
    same(enrich.enrich_as_of(events, config, "k", "told", "seq", PER_SLICE), ["seq", "told"], expected)


def test_lookup_join_splits_hot_keys(frame, data):
    config = frame.select("seq", "k", F.col("time").alias("name"))
    newest = {}
    for e in sorted(data):
        newest[e[2]] = e[1]
    expected = [(e[0], newest[e[2]]) for e in data if e[2] is not None]
    joined = enrich.broadcast_enrich(frame.select("seq", "k"), config, "k", "name", "seq", rows_per_key=PER_SLICE)
    same(joined, ["seq", "name"], expected)


def test_regroup_in_parts(frame, data):
    pairs = frame.select(F.coalesce("k", F.lit("none")).alias("key"), F.col("time").cast("int").alias("number"))
    groups = defaultdict(list)
    for e in data:
        groups[e[2] or "none"].append(e[1])
    whole = regroup.regroup(pairs, rows_per_slice=PER_SLICE)
    same(whole, ["line"], [("\t".join(map(str, [k, *sorted(v)])),) for k, v in groups.items()])
    parts = regroup.regroup(pairs, max_values=50, rows_per_slice=PER_SLICE).orderBy("key", "part").collect()
    joined = defaultdict(list)
    for p in parts:
        joined[p["key"]] += p["line"].split("\t")[1:]
    assert {k: [str(n) for n in sorted(v)] for k, v in groups.items()} == joined


@pytest.mark.parametrize("keys", ["k", None])
def test_heavy_order_values_are_split_further(spark, keys):
    """One document holds most lines, and one of its lines most words."""
    rng = random.Random(3)
    places = [(rng.randrange(40), 0, 0, i) for i in range(150)] + [(7, rng.randrange(60), 1, i) for i in range(300)]
    places += [(7, 11, 2, i) for i in range(500)]
    rng.shuffle(places)
    frame = rows(spark, [(*p, "hot") for p in places], "doc long, line long, kind long, pos long, k string")
    order = ["doc", "line", "kind", "pos"]
    plan = plan_slices(frame, keys, order, PER_SLICE)
    assert len(plan.levels) >= 4
    sizes = plan.assign(frame).groupBy(SLICE).count().agg(F.max("count")).head()[0]
    assert sizes <= 2 * PER_SLICE
    placed = rolling.row_index(frame, order, keys, rows_per_slice=PER_SLICE)
    same(placed, [*order, "position"], [(*p, i + 1) for i, p in enumerate(sorted(places))])


def test_text_as_second_order_column(spark):
    places = [(7, f"name{i:04d}") for i in range(400)] + [(i, "x") for i in range(60)] + [(3, None)]
    random.Random(4).shuffle(places)
    frame = rows(spark, places, "doc long, name string")
    for per_slice in (PER_SLICE, None):
        placed = rolling.row_index(frame, ["doc", "name"], rows_per_slice=per_slice)
        expected = sorted(places, key=lambda p: (p[0], p[1] is not None, p[1] or ""))
        same(placed, ["doc", "name", "position"], [(*p, i + 1) for i, p in enumerate(expected)])


def test_null_and_infinite_order_values(spark):
    places = [(None, i) for i in range(300)] + [(float("nan"), i) for i in range(300)] + [(1.5, i) for i in range(20)]
    frame = rows(spark, places, "o double, tie long")
    for first in (places[:300], places[300:600], places):
        part = rows(spark, first, "o double, tie long")
        placed = {(r["tie"], str(r["o"])): r["position"] for r in rolling.row_index(part, ["o", "tie"], rows_per_slice=PER_SLICE).collect()}
        ordered = sorted(first, key=lambda p: (p[0] is not None, p[0] is not None and p[0] != p[0], p[0] if p[0] and p[0] == p[0] else 0, p[1]))
        assert [placed[t, str(o)] for o, t in ordered] == list(range(1, len(first) + 1))


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    from keyrill.plans import running, slices

    monkeypatch.setattr(slices, "MAX_BOUNDS", 3)
    monkeypatch.setattr(running, "MAX_CARRY_ROWS", 4)
    data = [(f"k{i % 9}", i, i % 5) for i in range(900)]
    frame = rows(spark, data, "k string, seq long, v long")
    summed = rolling.running_sum(frame, "k", "seq", "v", rows_per_slice=PER_SLICE)
    totals, expected = defaultdict(int), []
    for k, seq, v in data:
        totals[k] += v
        expected.append((seq, totals[k]))
    same(summed, ["seq", summed.columns[-1]], expected)


def test_three_hundred_hot_keys(spark):
    """Every slice of every key, whatever its size, has at most twice the rows of a slice."""
    rng = random.Random(9)
    data = [(f"k{k}", rng.randrange(10**6), i) for k in range(300) for i in range(PER_SLICE + 1 + (k % 40) * 9)]
    data += [("giant", rng.choice([5, rng.randrange(10**6)]), i) for i in range(30_000)]
    frame = rows(spark, data, "k string, at long, seq long")
    plan = plan_slices(frame, "k", ["at", "seq"], PER_SLICE)
    placed = plan.assign(frame)
    sizes = placed.groupBy("k", SLICE).agg(F.count("*").alias("n"), F.min(F.struct("at", "seq")).alias("lo"), F.max(F.struct("at", "seq")).alias("hi"))
    sliced = sizes.orderBy("k", SLICE).collect()
    assert max(r["n"] for r in sliced) <= 2 * PER_SLICE and placed.filter(f"{SLICE}.l0 < 0").count() == 0
    for a, b in zip(sliced, sliced[1:]):
        assert a["k"] != b["k"] or a["hi"] < b["lo"]
    assert len(plan.levels) >= 2  # thirty thousand rows in slices of forty take more than 256 of them
