from collections import defaultdict

import pytest
from compare import differences, views
from pyspark.sql import functions as F

from keyrill.llm import mixing
from keyrill.llm.queries import ORACLE, op3_pfair_mixing


def blocks_of(found):
    by_source = defaultdict(dict)
    for r in found:
        assert by_source[r.source].setdefault(r.block, (r.release, r.deadline, r.slot)) == (r.release, r.deadline, r.slot)
    return by_source


def check_windows(by_source):
    slots = [s for blocks in by_source.values() for _, _, s in blocks.values()]
    assert len(slots) == len(set(slots))
    assert all(a <= s < b for blocks in by_source.values() for a, b, s in blocks.values())


def test_query(spark, sf_dir):
    frame = op3_pfair_mixing(spark, sf_dir)
    check_windows(blocks_of(frame.collect()))
    assert differences(frame, views(sf_dir), ORACLE["op3_pfair_mixing"]) is None


@pytest.mark.parametrize("weights", [None, {"a": 3, "b": 1, None: 1}, {"a": 1}])
def test_edge_cases(docs, rows, weights):
    found = mixing.mix(docs, weights, block_bytes=700, period=11, chunks=4).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    by_source = blocks_of(found)
    assert set(by_source) == {r[3] for r in rows}
    check_windows(by_source)


def test_deviation_stays_below_one_block(spark):
    rows = [(i, "x" * 10, "abcd"[i % 4] if i % 3 else "a") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 5, "b": 2.5, "c": 1.5, "d": 1}
    by_source = blocks_of(mixing.mix(docs, weights, block_bytes=30, period=100).collect())
    shares = {s: len([1 for _, _, slot in v.values() if slot < 100]) for s, v in by_source.items()}
    assert sum(shares.values()) == 100
    for source, share in shares.items():
        done = 0
        taken = {slot for _, _, slot in by_source[source].values()}
        for t in range(100):
            done += t in taken
            assert abs(done - (t + 1) * share / 100) < 1


def test_names_empty_tables_and_too_many_sources(docs, empty):
    clash = docs.withColumn("slot", F.lit("mine")).withColumn("share", F.lit(1))
    found = mixing.mix(clash)
    assert dict(found.dtypes)["slot"] == "bigint" and "share" in found.columns and len(found.columns) == len(set(found.columns))
    assert mixing.mix(empty).collect() == []
    assert [r.doc_id for r in mixing.in_mix_order(docs.filter("doc_id = 144")).collect()] == [144]
    with pytest.raises(ValueError, match="period"):
        mixing.mix(docs, period=2)
