import hashlib
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyrill.llm import storage, suffix_dedup, suffixes
from keyrill.llm.queries import op2_suffix_dedup


def brute(rows, length=100):
    seen, out = {}, {}
    for d, text in sorted(set(rows), key=lambda r: r[0]):
        data = (text or "").encode()
        covered = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if seen.setdefault(data[i : i + length], (d, i)) != (d, i):
                covered[i : i + length] = True
        kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out[d] = (len(data), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def found_rows(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    frame = op2_suffix_dedup(spark, sf_dir)
    assert found_rows(frame) == brute(rows)
    assert frame.count() == len(rows)


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"block_bytes": 500}])
def test_edge_cases(docs, rows, options):
    frame = suffix_dedup.suffix_digest(docs, **options)
    assert found_rows(frame) == brute([(r[0], r[1]) for r in rows])
    assert frame.count() == len(rows)


def test_short_strings(docs, rows):
    frame = suffix_dedup.suffix_digest(docs, length=50)
    assert found_rows(frame) == brute([(r[0], r[1]) for r in rows], 50)


def test_passed_files_go(spark):
    """Shuffle files of a written table, and a passing table's files, do not stay until the driver ends."""
    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())

    def files():
        return {f.name for f in local.glob("*/shuffle_*.data")}

    there = files()
    table, drop = storage.passing(spark.range(10_000).groupBy((F.col("id") % 977).alias("k")).count().repartition("count"), "passing")
    end = time.time() + 30
    while files() - there and time.time() < end:  # Spark removes them in the background
        time.sleep(0.2)
    assert not files() - there and spark.conf.get(storage.CLEAN, "false") == "false"
    folder = Path(table.select("_metadata.file_path").head()[0].removeprefix("file:")).parent
    assert table.count() == 977 and folder.exists()
    drop()
    assert not folder.exists()


def test_null_ids_and_empty_tables(spark, empty):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(300))
    frame = spark.createDataFrame([(None, text), (3, text)], "doc_id long, text string")
    assert found_rows(suffix_dedup.suffix_digest(frame))[None][:3] == (300, 300, 1)
    assert suffix_dedup.suffix_digest(empty).collect() == []


def test_texts_stay_text(spark):
    rng = random.Random(2)
    body = "".join(rng.choice("é北a ") for _ in range(120))
    frame = spark.createDataFrame([(1, "x" + body, 5), (2, "é" + body + "ñ", 6)], "doc_id long, text string, n_spans long")
    kept = {r.doc_id: r for r in suffix_dedup.dedup(frame).collect()}
    assert kept[1].text == "x" + body
    assert kept[2].text == "éñ" and kept[2].n_spans == 1
    assert kept[2].n_removed == len(body.encode())


def test_two_stage_sorting():
    rng = random.Random(5)
    for _ in range(150):
        depth = 20
        data = bytes(rng.choice(b"ab\0c"[: rng.randrange(1, 5)]) for _ in range(rng.randrange(1, 200)))
        text = np.frombuffer(data + bytes(depth + 9), np.uint8)
        wanted = np.array(sorted(rng.sample(range(len(data)), rng.randrange(1, len(data) + 1))))
        order = suffixes.sort_suffixes(text, wanted, depth)
        keys = [text.tobytes()[i : i + depth] for i in order]
        assert sorted(order.tolist()) == wanted.tolist() and keys == sorted(keys)
        shared = suffixes.common_prefix(text, order, depth)
        for i in range(1, len(keys)):
            same = [a == b for a, b in zip(keys[i - 1], keys[i], strict=True)] + [False]
            assert shared[i] == same.index(False)
