import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from test_mixing import blocks_of, check_windows

from keyrill.llm import mixing


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(1, 90), f"host{min(int(rng.expovariate(1 / 300)), 1200)}") for i in range(4000)]
    rows += [(5000 + i, "y" * 10, f"host{i}") for i in range(1300)] + [(7000 + i, "y" * 50, None) for i in range(200)] + [(8000, "z", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


@pytest.mark.parametrize("broadcast", [mixing.MOST_BROADCAST, 100])
def test_any_number_of_sources(many, broadcast, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BROADCAST", broadcast)
    docs, rows = many
    found = mixing.mix_digest(docs, block_bytes=40).collect()
    assert sorted(r.doc_id for r in found) == sorted(d for d, _, _ in rows)
    by_source = blocks_of(found)
    assert set(by_source) == {s for _, _, s in rows} and len(by_source) > 720
    check_windows(by_source)


@pytest.mark.parametrize("options", [{}, {"weights": {"host0": 0.5, "host7": 0.25, None: 0.2, "": 0.05}}])
def test_broadcast_and_shuffle_give_the_same_rows(many, options, monkeypatch):
    docs, _ = many
    plain = sorted(map(tuple, mixing.mix_digest(docs, block_bytes=40, **options).collect()), key=str)
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 100)
    assert sorted(map(tuple, mixing.mix_digest(docs, block_bytes=40, **options).collect()), key=str) == plain


def plain_layout(shares, period):
    """Slot by slot: of the released blocks the one that is due first, then the larger share, then the name."""
    order = sorted(shares, key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    done, found = dict.fromkeys(order, 0), []
    for t in range(period):
        due = [(-(-(done[s] + 1) * period // s[1]), i) for i, s in enumerate(order) if done[s] < s[1] and done[s] * period // s[1] <= t]
        source = order[min(due)[1]]
        found.append((*source, done[source], t))
        done[source] += 1
    return found


def test_layout_is_earliest_deadline_first(spark):
    rows = [(None, 9), ("", 9), ("a", 20), ("b", 3), ("c", 3), ("d", 3), ("e", 1), ("f", 1), ("g", 1)]
    shared = spark.createDataFrame(rows, "source string, share long")
    assert sorted(map(tuple, mixing.layout(shared, 50).collect()), key=str) == sorted(plain_layout(rows, 50), key=str)
    rng = random.Random(3)
    rows = [(f"s{i}", rng.randrange(1, 90)) for i in range(40)]
    period = sum(n for _, n in rows)
    assert period > 2 * mixing.STEPS
    shared = spark.createDataFrame(rows, "source string, share long")
    assert sorted(map(tuple, mixing.layout(shared, period).collect())) == sorted(plain_layout(rows, period))


@pytest.mark.parametrize("n", [2, 20, 360, 720, 721])
def test_half_for_one_of_many(spark, n):
    """After every slot, the blocks of a source are within one of the given weight, in exact fractions."""
    rows = [(i, "x" * 10, "large") for i in range(2 * n)] + [(10_000 + i, "x" * 10, f"s{i // 3}") for i in range(3 * (n - 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"large": 0.5, **{f"s{i}": Fraction(1, 2 * (n - 1)) for i in range(n - 1)}}
    by_source = blocks_of(mixing.mix_digest(docs, weights=weights, block_bytes=10).collect())
    check_windows(by_source)
    # A source has run out after the windows of its last block; until then the weights hold.
    end = min(math.floor(len(blocks) / Fraction(weights[s])) for s, blocks in by_source.items())
    assert end >= 4 * (n - 1)
    for source, blocks in by_source.items():
        taken = {slot for _, _, slot in blocks.values()}
        done, weight = 0, Fraction(weights[source])
        for t in range(end):
            done += t in taken
            assert abs(done - (t + 1) * weight) < 1


def test_rounded_weights_stay_within_a_block_of_rounding(spark):
    rows = [(i, "x" * 40, f"s{i % 7 * (i % 3)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = Counter(s for _, _, s in rows)
    weights = {s: (40 * n) ** mixing.TEMPER for s, n in sizes.items()}
    by_source = blocks_of(mixing.mix_digest(docs, block_bytes=80).collect())
    end = min(math.floor(len(b) * sum(weights.values()) / weights[s]) for s, b in by_source.items())
    for source, blocks in by_source.items():
        taken = {slot for _, _, slot in blocks.values()}
        done = 0
        for t in range(end):
            done += t in taken
            assert abs(done - (t + 1) * weights[source] / sum(weights.values())) < 2


def test_columns_of_any_name(spark):
    names = ["_bytes", "_places", "_start", "_tie", "_chunk", "_source", "_none", "_in", "_share", "block", "slot", "kept", "a.b"]
    docs = spark.createDataFrame([(i, "x" * i, "ab"[i % 2], *[i] * len(names)) for i in range(9)], ["doc_id", "text", "source", *names])
    found = mixing.in_mix_order(docs)
    assert found.columns == docs.columns
    assert all(set(r[3:]) == {r.doc_id} for r in found.collect())
    assert set(mixing.mix(docs).columns) == {*docs.columns, *mixing.MIXED}
