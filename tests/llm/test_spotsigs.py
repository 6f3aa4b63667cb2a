import hashlib

import pytest
from pyspark.sql import functions as F

from keyrill.llm import spotsigs
from keyrill.llm.queries import op4_spotsigs


def plain_pairs(rows):
    """n_chars and the digest of the edited text, by document."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for at, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    return out


def check(frame, rows):
    expected, prints = plain_pairs(rows), {}
    texts = dict(rows)
    found = frame.collect()
    assert sorted(r.doc_id for r in found) == sorted(expected)
    for r in found:
        assert (r.n_chars, r.edited_sha256) == expected[r.doc_id]
        assert prints.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b = ({f[i : i + 8] for i in range(0, len(f), 8)} for f in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b))
    assert len(set(prints.values())) == len(prints)
    return found


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = plain_pairs(rows)
    found = op4_spotsigs(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == expected


@pytest.mark.parametrize("per_range", [4, 512])
def test_edge_cases(spark, docs, rows, empty, monkeypatch, per_range):
    monkeypatch.setattr(spotsigs, "DOCS_PER_RANGE", per_range)
    once = {r[0]: r[1] for r in rows}
    check(spotsigs.spotsigs_digest(docs.dropDuplicates(["doc_id"])), list(once.items()))
    assert spotsigs.spotsigs_digest(docs).count() == len(rows)
    assert spotsigs.spotsigs_digest(empty).collect() == []
    alone = spark.createDataFrame([(None, "the river runs fast")], "doc_id long, text string")
    assert spotsigs.spotsigs_digest(alone).head().near_next == 1.0


def test_signatures(spark):
    frame = spark.createDataFrame([("The river of the old stone bridge",)], "text string")
    count = frame.select(F.size(spotsigs.signatures(F.col("text"))).alias("n")).head().n
    assert count == 3  # the: river old, of: old stone, the: old stone


def test_similar(docs, rows):
    prints = spotsigs.fingerprints(docs)
    pairs, members = spotsigs.similar(prints, 0.3)
    sets = {}
    for r in prints.collect():
        sets.setdefault(tuple(r.signatures), set()).add(r.doc_id)
    of = {}
    for r in members.collect():
        of.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(map(sorted, of.values())) == sorted(map(sorted, sets.values()))
    keys = list(sets)
    expected = {
        frozenset((min(sets[a]), min(sets[b])))
        for i, a in enumerate(keys) for b in keys[i + 1 :]
        if len(set(a) & set(b)) >= 0.3 * len(set(a) | set(b))
    }
    assert {frozenset((min(of[r.a]), min(of[r.b]))) for r in pairs.collect()} == expected
    assert expected
