import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from keyrill.llm import repair
from keyrill.llm.repair import CUT, FINE, GONE, Table, align, edits

INF = 10**9
sys.setrecursionlimit(20_000)


def brute_align(initials, states):
    """Least (cost, audit) over a walk through turns and grammar: 0 start, 1 after s, 2 wants a, 3 may end."""
    n = len(states)

    @lru_cache(None)
    def best(i, at, inserted):
        options = [(0, "")] if i == n and at in (0, 3) else []
        step = {0: "u", 1: "u", 2: "a", 3: "u"}[at]
        after = 3 if step == "a" else 2

        def then(cost, letter, *state):
            rest = best(*state)
            if rest[0] < INF:
                options.append((rest[0] + cost, letter + rest[1]))

        if inserted < 3:  # a fourth in a row only comes round
            then(3, "I", i, after, inserted + 1)
        if i < n:
            then(4, "D", i + 1, at, 0)
            if states[i] != GONE:
                more = 3 * (states[i] == CUT)
                if at == 0 and initials[i] == "s":
                    then(more, "K", i + 1, 1, 0)
                if initials[i] == step:
                    then(more, "K", i + 1, after, 0)
                else:
                    then(more + 3, "R", i + 1, after, 0)
        return min(options, default=(INF, ""))

    return best(0, 0, 0)


def brute(rows):
    """Faults and repair of the rows (turn, role, text) of one conversation after damage, in order."""
    seen, states, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        states.append({"blank": GONE, "duplicate": GONE, "truncated": CUT, None: FINE}[fault])
        if fault:
            counts[fault] += 1
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = brute_align(tuple(initials), tuple(states))
    left, out = list(rows), []
    size = sum(c != "D" for c in audit)
    for c in audit:
        place = "s" if size % 2 and not out else ("user", "assistant")[(len(out) - size % 2) % 2]
        if c == "I":
            out.append(f"{place}:")
            continue
        _, role, text = left.pop(0)
        if c != "D":
            out.append(f"{role if c == 'K' else place}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha


def brute_damage(rows):
    """Rows (conv_id, turn, role, text) by conversation after damage, in order."""
    found = {}
    for conv_id, turn, role, text in rows:
        held = found.setdefault(conv_id, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return {c: sorted(h, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r))) for c, h in found.items()}


def shape(rng, n):
    initials = "".join(rng.choices("uas?x", [6, 6, 2, 1, 1], k=n))
    if rng.random() < 0.5:
        initials = "".join("ua"[i % 2] if rng.random() < 0.85 else c for i, c in enumerate(initials))
    return initials, bytes(rng.choices([FINE, CUT, GONE], [8, 2, 2], k=n))


def test_align_equals_brute_force():
    rng = random.Random(5)
    for n in range(0, 9):
        for _ in range(1 if n == 0 else 150):
            initials, states = shape(rng, n)
            assert align(initials, states) == brute_align(initials, tuple(states)), (initials, states)
    for n in (30, 60, 90):
        for _ in range(5):
            initials, states = shape(rng, n)
            assert align(initials, states) == brute_align(initials, tuple(states))


def test_rows_filled_again(monkeypatch):
    rng = random.Random(6)
    some = [shape(rng, n) for n in (20, 41, 64)]
    expected = [align(*s) for s in some]
    monkeypatch.setattr(repair, "MOST_CELLS", 1)
    monkeypatch.setattr(repair, "STEP", 7)
    assert [align(*s) for s in some] == expected
    assert len(Table(*some[2], 60).kept) <= 64 // 7 + 2


def test_a_narrow_band_is_widened():
    initials = "u" * 40
    assert align(initials, bytes(40)) == brute_align(initials, (FINE,) * 40)
    assert align("a" * 12 + "s" + "u" * 9, bytes(22)) == brute_align("a" * 12 + "s" + "u" * 9, (FINE,) * 22)


def test_edits():
    assert list(edits("DKIKR")) == [("D", None), ("K", "user"), ("I", "assistant"), ("K", "user"), ("R", "assistant")]
    assert list(edits("DKKK")) == [("D", None), ("K", "s"), ("K", "user"), ("K", "assistant")]


def fixture():
    rng = random.Random(8)
    texts = ["Well.", "so", " \t", "", None, "Why?\n", "é", "End!  \r\n", "a\x0b.", "…"]
    rows = []
    for conv_id in [*range(120), None, -7]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            number = rng.choice([turn, turn, turn, turn + 2, None])
            rows.append((conv_id, number, role, rng.choice(texts) if rng.random() < 0.6 else f"text {rng.randrange(9)}."))
    rows += [(500, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(150)]  # a long one
    rows += [(501, 3, "user", "long " * 40_000 + ".")]
    return rows


def test_query_form(spark):
    rows = fixture()
    frame = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, phase string, alive boolean").withColumn("alive", F.lit("no"))
    found = {r.conv_id: tuple(r)[1:] for r in repair.audit(repair.damaged(frame.repartition(5)), "alive").collect()}
    expected = {c: brute(h) for c, h in brute_damage(rows).items()}
    assert found == expected

    turns = {}
    for r in repair.repair(repair.damaged(frame), "alive").orderBy("position").collect():
        assert r.position == len(turns.setdefault(r.conv_id, []))
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    for conv_id, row in expected.items():
        assert hashlib.sha256("\n".join(turns.get(conv_id, [])).encode()).hexdigest() == row[-1]


def test_dropped_and_empty(spark):
    frame = spark.createDataFrame([(1, 2, "user", "x", False), (1, 3, None, None, False)], "conv_id long, turn long, role string, text string, alive boolean")
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.audit(frame, "alive").collect()] == [(1, 0, 0, 0, 0, 0, 0, "", empty)]
    assert repair.audit(frame.limit(0)).count() == 0 and repair.repair(frame, "alive").count() == 0
    clashing = frame.withColumn("alive", F.lit("no"))
    assert [r.blank for r in repair.audit(clashing).collect()] == [1]


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_query(spark, sf_dir, batch):
    from keyrill.llm.queries import QUERIES

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found == {c: brute(h) for c, h in brute_damage(rows).items()}
