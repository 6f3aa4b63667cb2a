from collections import Counter

import pytest
from compare import differences, views
from pyspark.sql import functions as F

from keyrill.llm import sharding
from keyrill.llm.queries import ORACLE, op9_extendible_sharding


def check(found, limit):
    size, count, above = Counter(), Counter(), Counter()
    for r in found:
        assert len(r.shard) == r.depth
        size[r.shard] += r.n_bytes
        count[r.shard] += 1
    for shard, total in size.items():
        assert total <= limit or count[shard] == 1
        for k in range(len(shard)):
            assert shard[:k] not in size
            above[shard[:k]] += total
    assert all(total > limit for total in above.values())  # only what was too large is split


def test_query(spark, sf_dir):
    frame = op9_extendible_sharding(spark, sf_dir)
    assert frame.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert differences(frame, views(sf_dir), ORACLE["op9_extendible_sharding"]) is None


@pytest.mark.parametrize("limit", [1_000_000_000, 20_000, 1_500])
def test_limits(docs, rows, limit):
    found = sharding.assign(docs.withColumn("shard", F.lit(1)), limit).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    assert all(r.n_bytes == len((r.text or "").encode()) for r in found)
    check(found, limit)


def test_rows_of_one_id_are_parted(spark, empty):
    same = spark.createDataFrame([(7, "x" * 100)] * 300 + [(None, "y" * 50)] * 20, "doc_id long, text string")
    found = sharding.assign(same, 1_000).collect()
    check(found, 1_000)
    assert len(found) == 320 and max(r.depth for r in found) > 32
    assert sharding.assign(empty).collect() == []


def test_written_shards(spark, docs, tmp_path):
    assigned = sharding.assign(docs, 20_000)
    sharding.write(assigned, str(tmp_path / "out"))
    names = {p.name.removeprefix("shard=") for p in (tmp_path / "out").glob("shard=*")}
    assert len(names) == sharding.directory(assigned).count()
