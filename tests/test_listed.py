import random

import pytest
from pyspark.sql import functions as F

from keyrill.catalog.batch import QUERIES
from keyrill.functions.text import lines_of, tokens_of
from keyrill.operators import listed
from keyrill.plans import running, slices


@pytest.fixture(scope="module")
def texts():
    """Texts with empty lines, lines of spaces, no words that match or nothing else; keys that come twice, or never."""
    rng = random.Random(7)
    lines = ["", "  ", "the", "a b c", "th the then", "x the y", " lead the  two ", "those"]
    docs = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))) for k in range(60)]
    docs += [(60, None), (61, ""), (62, "the " * 200 + "end")]
    # Of rows with equal key the longer text goes on where the shorter one ends, so equal places have equal words.
    docs += [(5, docs[5][1]), (62, "the " * 200), (None, "the a\nth"), (None, "the a\nth b"), (None, "the a\nth")]
    return docs


def expected(docs):
    words = []
    for key, text in docs:
        if text is None:
            continue
        for line_no, line in enumerate(text.removesuffix("\n").split("\n")):
            stripped = line.rstrip(" ")
            items = [""] if line == "" else stripped.split(" ") if stripped else []
            words += [((key is not None, key or 0), line_no, pos, word) for pos, word in enumerate(items)]
    matches, rows = 0, []
    for n, (key, line_no, pos, word) in enumerate(sorted(words), 1):
        matches += word.startswith("th")
        rows.append((key[1] if key[0] else None, line_no, pos, matches, n - matches))
    return sorted(rows, key=str)


@pytest.mark.parametrize("per_slice", [7, None])
@pytest.mark.parametrize("repeated", [True, False])
def test_counts_as_a_loop(spark, texts, per_slice, repeated):
    docs = texts if repeated else texts[:61]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = listed.running_item_counts(frame, "doc_id", lines_of(F.col("text")), tokens_of, lambda w: w.startswith("th"), per_slice)
    assert found.columns == ["doc_id", "list_no", "pos", "matches", "others"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(docs)


def test_nothing(spark):
    frame = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert not listed.running_item_counts(frame, "doc_id", lines_of(F.col("text")), tokens_of, lambda w: w.startswith("th")).collect()


def test_totals_are_run_over_lines_not_words(spark, tmp_path, monkeypatch):
    docs = [(i, "the a b c d e f g h i\nthen " + "w " * 40) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    written, kept = [], running.stored

    def counted(df, purpose):
        found = kept(df, purpose)
        written.append(found.count())
        return found

    monkeypatch.setattr(slices, "ROWS_PER_SLICE", 30)
    monkeypatch.setattr(running, "stored", counted)
    found = QUERIES["variant_running_totals"](spark, str(tmp_path))
    shown = [(d, n, p, f"match:{m},noMatch:{o}") for d, n, p, m, o in expected(docs)]
    assert sorted(map(tuple, found.select("doc_id", "line_no", "pos", "totals").collect()), key=str) == sorted(shown, key=str)
    assert written and max(written) <= 2 * len(docs)
