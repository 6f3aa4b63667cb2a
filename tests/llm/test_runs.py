import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyrill.llm import runs
from keyrill.llm.runs import kept_words, least_shared, longest, maximal_runs, runs_of, suffix_order


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, shortest=24, times=3):
    """Every stretch of period q that cannot be extended, by trying each q."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(shortest, times * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_digest(text):
    words = words_of(text)
    found = brute_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return len(found), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept)


def brute_planted(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def texts():
    rng = random.Random(11)
    out = [None, "", " \n\t ", "a " * 23, "a " * 24, "a " * 500, "a b " * 12, "a b c d e f g h " * 3, "a b c d e f g h " * 2, "x " + "a " * 30 + "y"]
    for _ in range(400):
        letters = "ab" if rng.random() < 0.5 else "abcde"
        parts = []
        for _ in range(rng.randrange(1, 6)):
            unit = [rng.choice(letters) for _ in range(rng.randrange(1, 12))]
            parts += unit * rng.randrange(1, 9) + unit[: rng.randrange(0, len(unit) + 1)]
        out.append(" ".join(parts))
    # One passage many times, with other words around it, and runs of runs.
    passage = [f"w{i}" for i in range(40)]
    out.append(" ".join(w for i in range(60) for w in [f"x{i}", *passage]))
    out.append(" ".join((["a"] * 30 + ["b"]) * 20))
    out.append(" ".join(w for i in range(30) for w in [f"x{i}", *["a"] * 40]))
    return out


def test_suffix_order():
    rng = np.random.default_rng(3)
    for size in (1, 2, 50, 300):
        for letters in (1, 2, 9):
            codes = rng.integers(0, letters, size)
            assert suffix_order(codes).tolist() == sorted(range(size), key=lambda i: codes[i:].tolist())


def test_runs_equal_brute_force():
    for text in texts():
        words = words_of(text)
        known = {w: i for i, w in enumerate(sorted(set(words)))}
        assert maximal_runs([known[w] for w in words]) == brute_runs(words), text
        assert maximal_runs([known[w] for w in words], 10, 4) == brute_runs(words, 10, 4), text


@pytest.mark.parametrize("at_once", [1, 100, 1 << 19])
def test_runs_of_many_texts(monkeypatch, at_once):
    monkeypatch.setattr(runs, "WORDS_AT_ONCE", at_once)
    for text, (words, found) in zip(texts(), runs_of(texts()), strict=True):
        assert [w.decode() for w in words] == words_of(text) and found == brute_runs(words_of(text))


def test_least_shared():
    for shortest in range(3, 60):
        for times in (3, 4, 7):
            pairs = [(length, q) for q in range(1, 80) for length in range(1, 200) if length >= (times - 1) * q and length + q >= shortest]
            assert least_shared(shortest, times) == min(length for length, _ in pairs)


def test_two_periods_only_are_refused():
    with pytest.raises(ValueError):
        maximal_runs([1] * 30, 10, 2)


def test_ties_of_the_strongest_run():
    assert longest([]) is None
    assert longest([(0, 24, 8), (30, 30, 10), (70, 48, 16)]) == (0, 24, 8)
    assert kept_words(10, [(0, 6, 2), (4, 6, 2)]).tolist() == [True, True, False, False] + [False] * 6


def test_frame_forms(spark):
    rows = [(i, t, "clash", i) for i, t in enumerate(texts())] + [(None, "a " * 30, "x", 1), (3, "a " * 30, "x", 1), (3, "a " * 30, "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start string, n_runs long").repartition(4)
    found = sorted((tuple(r) for r in runs.run_digest(frame).collect()), key=str)
    assert found == sorted(((r[0], *brute_digest(r[1])) for r in rows), key=str)

    listed = runs.find(frame.drop("start")).collect()
    assert sorted(((r.doc_id, r.start, r.length, r.period) for r in listed), key=str) == sorted(
        ((r[0], *run) for r in rows for run in brute_runs(words_of(r[1]))), key=str)

    collapsed = runs.collapse(frame)
    assert collapsed.columns == frame.columns
    expected = []
    for doc_id, text, start, n in rows:
        if brute_runs(words_of(text)):
            words = words_of(text)
            gone = {i for s, size, q in brute_runs(words) for i in range(s + q, s + size)}
            text = " ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append((doc_id, text, start, n))
    assert sorted((tuple(r) for r in collapsed.collect()), key=str) == sorted(expected, key=str)
    assert runs.run_digest(frame.limit(0)).count() == 0


def test_query(spark, sf_dir, rows):
    from keyrill.llm.queries import QUERIES

    found = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect())
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found == sorted((d, *brute_digest(" ".join(brute_planted(d, t)))) for d, t in table)
    assert sum(r[1] > 0 for r in found) > 10

    some = [(r[0], r[1]) for r in rows] + [(None, "a b")]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    changed = frame.select("doc_id", runs.planted(F.col("doc_id"), F.col("text")).alias("text")).collect()
    for (doc_id, text), r in zip(some, changed, strict=True):
        assert words_of(r.text) == (words_of(text) if doc_id is None else brute_planted(doc_id, text))
