import random
import re

import numpy as np
import pytest
import xxhash

from keyrill.llm import simhash
from keyrill.llm.components import components
from keyrill.llm.queries import op6_simhash_dedup


def plain_fingerprint(text, size=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, distance=3):
    values = np.array(sorted({v for _, v in rows}), np.uint64)
    parent = {int(v): int(v) for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for v in values:
        for w in values[np.bitwise_count(values ^ v) <= distance]:
            parent[find(int(v))] = find(int(w))
    least = {}
    for d, v in rows:
        if d is not None:
            least[find(v)] = min(d, least.get(find(v), d))
    return sorted(((d, format(v, "016x"), least.get(find(v))) for d, v in rows), key=str)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op6_simhash_dedup(spark, sf_dir).collect()), key=str) == plain_classes(rows)


def test_edge_cases(docs, rows, empty):
    expected = plain_classes([(r[0], plain_fingerprint(r[1])) for r in rows])
    assert sorted((tuple(r) for r in simhash.simhash_digest(docs).collect()), key=str) == expected
    assert simhash.simhash_digest(empty).collect() == []
    assert simhash.near_dedup(empty).collect() == []


@pytest.mark.parametrize("dense", [simhash.DENSE, 3])
def test_chains(spark, dense):
    rng = random.Random(3)
    values = []
    for _ in range(20):
        v = rng.getrandbits(64)
        for _ in range(30):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])))
            values.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame(list(zip(range(len(values)), signed)), "doc_id long, fp long")
    found = {r.node: r.component for r in components(simhash.links(frame, 3, dense)).collect()}
    groups = {}
    for s, (_, _, c) in zip(signed, sorted(plain_classes(list(enumerate(values))), key=lambda r: r[0]), strict=True):
        groups.setdefault(found.get(s, s), set()).add(c)
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set().union(*groups.values()))


def test_one_of_each_group_stays(spark, docs, rows):
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    expected = {c for _, _, c in plain_classes([(r[0], plain_fingerprint(r[1])) for r in rows])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    nameless = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "q w e r t")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.near_dedup(nameless).collect()) == ["a b c d", "q w e r t"]
