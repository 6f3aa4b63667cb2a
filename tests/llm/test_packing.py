import math
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from keyrill.llm import packing
from keyrill.llm.queries import TOKENIZER, op1_pattern_packing


def check(rows, found, capacity):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    ids = {(d, t or ""): tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    expected = sorted(
        (d, piece, start, min(start + capacity, len(tokens)) - start if piece else first)
        for (d, _), tokens in zip(rows, (ids[d, t or ""] for d, t in rows), strict=True)
        for first in [(len(tokens) - 1) % capacity + 1]
        for piece, start in enumerate([0, *range(first, len(tokens), capacity)])
    )
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in found) == expected
    if len({d for d, _ in rows}) == len(rows):
        by_id = {d: ids[d, t or ""] for d, t in rows}
        for r in found:
            assert r.ids_crc32 == zlib.crc32(np.array(by_id[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(r.length for r in found)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used, total = check(rows, op1_pattern_packing(spark, sf_dir).collect(), 2048)
    assert used <= 1.02 * math.ceil(total / 2048) + 1


@pytest.mark.parametrize("slot", [3, 65_536])
def test_edge_cases(docs, rows, slot):
    found = packing.pack(docs, TOKENIZER, capacity=64, pieces_per_slot=slot).collect()
    check([(r[0], r[1]) for r in rows], found, 64)
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)


def test_empty(empty):
    assert packing.pack(empty, TOKENIZER).collect() == []


def test_plan_places_every_rank_once():
    rng = np.random.default_rng(3)
    histogram = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 257), 120, replace=False), rng.integers(1, 400, 120), strict=True)}
    runs = packing.plan(histogram, 256)
    used = {}
    for length, first, count, sequence, offset in runs.tolist():
        for k in range(count):
            assert used.setdefault((length, first + k), True) is True
            used.setdefault(("seq", sequence + k), []).append((offset, length))
    assert sum(1 for k in used if k[0] != "seq") == sum(histogram.values())
    for key, parts in used.items():
        if key[0] == "seq":
            ends = 0
            for offset, length in sorted(parts):
                assert offset == ends
                ends += length
            assert ends <= 256


def test_ranked_encoding_equals_the_tokenizer(rows):
    encode = packing.Encoder(TOKENIZER)
    assert encode.fast is not None
    for text in [r[1] or "" for r in rows] + ["<|endoftext|> a", "a   b\n \n c", "\x00\t x"]:
        assert encode(text) == np.array(encode._plain(text), "<u4").tobytes()
