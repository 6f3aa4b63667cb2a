import random

import corpus_pipeline
import numpy as np
import pytest

from keyrill.llm import near_copies


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """Smallest doc_id of every component by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            if x == sets[j] or shared and 5 * shared >= 4 * (len(x) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


@pytest.fixture(scope="module")
def edited():
    """Chains of small edits, a group of mutual near copies and pairs just under and over 0.8."""
    rng = random.Random(5)
    rows = []
    for group in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 240))]
        for _ in range(rng.randrange(1, 8)):
            words = list(words)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(3000)}"
            rows.append((len(rows), " ".join(words)))
    base = [f"c{i}" for i in range(300)]
    for i in range(60):
        rows.append((len(rows), " ".join([*base[: 5 * i % 290], f"x{i}", *base[5 * i % 290 :]])))
    return rows


def test_stage_finds_what_all_pairs_find(spark, edited):
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in edited], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == expected(edited)


def test_supplied_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in near_copies.near_dedup(docs).collect()) == expected(rows)


def test_edge_cases(spark, docs, rows, empty):
    assert sorted(r.doc_id for r in near_copies.near_dedup(docs).collect()) == expected([(r[0], r[1]) for r in rows])
    assert near_copies.near_dedup(empty).collect() == []
    nameless = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "q w e r t")], "doc_id long, text string")
    assert sorted(r.text for r in near_copies.near_dedup(nameless).collect()) == ["a b c d", "q w e r t"]


def test_long_lists_are_cut_into_blocks(spark, edited, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 7)
    docs = spark.createDataFrame(edited, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.near_dedup(docs).collect()) == expected(edited)


def test_texts_just_under_the_similarity_are_not_compared_in_all_pairs(spark, monkeypatch):
    """Copies of one text with four or five edits each: next to no pair reaches 0.8, and most of them 0.65."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(30), rng.randrange(4, 6)):
            words[5 * at] = f"e{rng.randrange(100_000)}"
        rows.append((i, " ".join(words)))
    made, kept = [], near_copies.materialize

    def counted(df, purpose):
        found = kept(df, purpose)
        made.extend([found.count()] * (purpose == "near-copies-pairs"))
        return found

    monkeypatch.setattr(near_copies, "materialize", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.near_dedup(docs).collect()) == expected(rows)
    assert sum(made) <= 4 * len(rows)


def test_odd_sketches_never_tell_more_than_the_sets_differ():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.choice([1, 5, 40, 300, 9000])
        x = {rng.getrandbits(64) for _ in range(n)}
        y = {h for h in x if rng.random() < 0.8} | {rng.getrandbits(64) for _ in range(rng.randrange(n + 1))}
        both = [near_copies.odd_sketch(np.array(sorted(s), np.uint64)).tobytes() for s in (x, y or x)]
        widths, tables = near_copies._folded(both)
        table = tables[int(widths.min())]
        assert int(np.bitwise_count(table[0] ^ table[1]).sum()) <= len(x ^ (y or x))


def test_columns_of_any_name(spark):
    names = ["_head", "_n", "_c", "_row", "row", "node", "component", "kept", "a.b"]
    docs = spark.createDataFrame([(i, f"w{i // 2} a b c d e", *[i] * len(names)) for i in range(8)], ["doc_id", "text", *names])
    found = near_copies.near_dedup(docs)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect())) == [tuple([i, f"w{i // 2} a b c d e"] + [i] * len(names)) for i in range(0, 8, 2)]


def test_similar_sets_share_a_list():
    """Sets with the least similarity that links, and some with more: equal, or in a list of both."""
    rng = random.Random(13)
    for n in [*range(1, 60), *[rng.randrange(60, 600) for _ in range(100)], 9000]:
        for _ in range(20 if n < 60 else 2):
            x = {rng.getrandbits(64) for _ in range(n)}
            gone = rng.randrange(n // 5 + 1)
            new = max(0, (5 * (n - gone) - 4 * n) // 4)  # as many as the similarity allows
            y = set(list(x)[gone:]) | {rng.getrandbits(64) for _ in range(new)}
            assert 5 * len(x & y) >= 4 * len(x | y)
            a, b = (near_copies.posts(np.array(sorted(s), np.uint64)) for s in (x, y))
            assert x == y or set(a.tolist()) & set(b.tolist()), (n, gone, new)


def test_ranges_without_shingles_do_not_hide_a_pair():
    """All shingles in few ranges, and a difference in each of these."""
    x = np.array([1, 2, 3, 4, 1 << 63, (1 << 63) + 1, (1 << 63) + 2, (1 << 63) + 3, (1 << 63) + 4], np.uint64)
    y = np.array(sorted([*x.tolist(), 7, (1 << 63) + 9]), np.uint64)
    assert 5 * len(x) >= 4 * len(y)
    assert set(near_copies.posts(x).tolist()) & set(near_copies.posts(y).tolist())


def test_pairs_that_signatures_miss_are_found(spark):
    rng, rows = random.Random(2), []
    while len(rows) < 8:
        words = [f"w{rng.randrange(10**9)}" for _ in range(49)]
        other = [*words[:20], "edited", *words[21:]]  # 40 of 50 shingles in both
        x, y = (near_copies.signature(near_copies.grams(" ".join(t))) for t in (words, other))
        if (x == y).sum() < near_copies.MINIMUM:
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert expected(rows) == [0, 2, 4, 6]
    assert sorted(r.doc_id for r in near_copies.near_dedup(docs).collect()) == [0, 2, 4, 6]


def test_each_group_keeps_a_document_if_doc_ids_repeat(spark):
    rows = [(3, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v"), (5, "g h i j k l"), (7, "g h i j k l")]
    found = near_copies.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == [(3, "a b c d e f"), (5, "g h i j k l"), (5, "q r s t u v")]
