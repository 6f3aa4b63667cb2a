import math
import re
from collections import defaultdict

import pytest
from compare import differences, views
from pyspark.sql import functions as F

from keyrill.llm import quality
from keyrill.llm.queries import ORACLE, op7_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def measured_rows(frame):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return sorted((r.doc_id, *[r[n] for n in names]) for r in frame.collect())


def test_query_measures(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    frame = op7_quality_rules(spark, sf_dir)
    assert measured_rows(frame) == sorted((r.doc_id, *plain(r.text)) for r in rows)
    assert frame.filter("base_failed and kept").count() == 0


def test_query_sql(spark, sf_dir):
    assert differences(op7_quality_rules(spark, sf_dir), views(sf_dir), ORACLE["op7_quality_rules"]) is None


def test_edge_cases(spark, docs, rows, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0), (None, 1, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.quality(docs.withColumn("n_words", F.lit("clash")), labels)
    assert measured_rows(found) == sorted((r[0], *plain(r[1])) for r in rows)
    assert quality.quality_digest(docs, labels.limit(0)).filter("kept = base_failed").count() == 0
    assert quality.quality_digest(empty, labels).collect() == []


@pytest.mark.parametrize(("k", "n", "risk"), [(0, 500, 0.01), (3, 1000, 0.01), (9, 1000, 0.02), (30, 4000, 0.01), (5, 10, 0.1), (0, 0, 0.01)])
def test_binomial_tail(spark, k, n, risk):
    exact = sum(math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1))
    found = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), risk)).head()[0]
    if k >= n * risk:
        assert found == 1.0
    else:
        assert found == pytest.approx(exact, rel=1e-9)


def test_large_counts_do_not_underflow(spark):
    tail = quality.binomial_tail(F.lit(9_500).cast("long"), F.lit(1_000_000).cast("long"), 0.01)
    assert 1e-8 < spark.range(1).select(tail).head()[0] < 1e-6


def test_cutoffs_keep_the_promise(spark):
    """A rule that parts good from bad is used; one that would reject too many good documents is not."""
    filler = " ".join(f"plain{i}" for i in range(40))
    rows = [(i, f"{filler} tail{i}", "en") for i in range(2000)]
    rows += [(3000 + i, " ".join(f"w{j}a{i}%%%" for j in range(30)), "en") for i in range(100)]
    rows += [(4000 + i, " ".join(f"w{j}a{i}%%%" for j in range(30)), "few") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 3000), 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.quality_digest(docs, labels).collect()}
    assert all(kept[i] for i in range(2000))
    assert not any(kept[3000 + i] for i in range(100))
    assert all(kept[4000 + i] for i in range(20))  # nothing can be proven for this stratum
