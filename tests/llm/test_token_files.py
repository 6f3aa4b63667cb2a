import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keyrill.llm import token_files
from keyrill.llm.token_files import EliasFano, TokenFile, WordEncoder, pack
from keyrill.sinks.files import filesystem

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("values", [
    [], [0], [7], [5, 5, 5, 9], [0] * 1000, list(range(3000)) + [1 << 63],
    sorted(np.random.default_rng(1).integers(0, 1 << 62, 3000).tolist()),
    sorted(np.random.default_rng(2).integers(0, 900, 3000).tolist()),
])
def test_elias_fano(values):
    coded, end = EliasFano.from_bytes(EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert [v for part in coded.values(100) for v in part.tolist()] == values
    k = np.random.default_rng(3).permutation(len(values))
    assert coded[k].tolist() == [values[i] for i in k]
    if len(values) >= 1000:
        assert 8 * end <= len(values) * (3 + max(1, values[-1] // len(values)).bit_length()) + 1000


def test_low_bits_are_packed_some_at_a_time():
    values = np.arange(1 << 17, dtype=np.uint64) << np.uint64(40)
    tracemalloc.start()
    coded = EliasFano.of(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20 and coded[[0, 1, 4097, len(values) - 1]].tolist() == [0, 1 << 40, 4097 << 40, (len(values) - 1) << 40]


def test_texts_are_encoded_by_number_and_bytes():
    texts = ["a"] * 600 + ["b" * (3 << 20)] * 3 + [None, "c" * (9 << 20), ""]
    found = [*token_files.portions(pa.array(texts))]
    assert found == [(0, 256), (256, 512), (512, 601), (601, 602), (602, 604), (604, 605), (605, 606)]
    assert [*token_files.portions(pa.array([], pa.string()))] == []


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_gives_the_ids_of_whole_texts(path, rows):
    encode, expected = WordEncoder(path), plain(path)
    assert encode.by_word is (path == WORDS)
    texts = [r[1] or "" for r in rows]
    texts += ["\x1c a\x85b c d", "ó ó ́x", "İΣΑΣ σς ẞß", "it's we'LL 'S x'y", "a.,b,. ...! 12a3 é99%%% _x_", "<|endoftext|> <|startoftext|>x", "北京 😀 \x00"]
    for _ in range(2):  # the second time from the kept words
        found = [np.frombuffer(e, encode.kind).tolist() for e in encode(texts)]
        assert found == [expected(t) for t in texts]


def expected_rows(rows, path):
    encode, start, out = plain(path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(text), 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_bytes", [64, 1 << 20])
def test_round_trip(spark, docs, rows, tmp_path, file_bytes):
    both = [(r[0], r[1]) for r in rows] + [(None, "no id"), (-(1 << 63), "x"), ((1 << 63) - 1, "y")]
    frame = spark.createDataFrame(both, "doc_id long, text string").withColumn("tie", F.lit("clash")).withColumn("start", F.lit(1)).repartition(5)
    files = token_files.write(frame, str(tmp_path / "ids"), WORDS, file_bytes=file_bytes)
    found = sorted(token_files.read(files, str(tmp_path / "ids"), with_ids=True).collect(), key=lambda r: (r.start, r.n_tokens))
    assert [tuple(r)[:4] for r in found] == expected_rows(both, WORDS)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    assert files.count() > 10 or file_bytes > 64

    # One document by its number, and by its id, without reading the others.
    fs, root = filesystem(str(tmp_path / "ids"))
    encode = plain(WORDS)
    texts = {r[0]: r[1] for r in both}
    for name in [r.file for r in files.collect()][:6]:
        with fs.open_input_file(f"{root}/{name}") as f:
            held = TokenFile(lambda at, n: f.read_at(n, at))
            for k in range(held.n):
                doc_id = held.doc_id(k)
                assert held.document(k).tolist() == [*encode(texts[doc_id]), 1]
                if doc_id is not None:
                    assert held.doc_id(held.find(doc_id)) == doc_id
            assert held.find(99) is None


def test_repeated_ids_are_dealt_over_tasks(spark, tmp_path):
    frame = spark.range(4000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files = token_files.write(frame, str(tmp_path / "same"), WORDS)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.select("part").distinct().count() > 1 and files.agg(F.sum("documents")).head()[0] == 4000


def test_files_of_short_texts_hold_a_bounded_number_of_documents(spark, tmp_path):
    n = token_files.FILE_DOCUMENTS + 70_000
    frame = spark.range(n).select(F.lit(7).alias("doc_id"), F.lit("").alias("text"))
    files = token_files.write(frame, str(tmp_path / "short"), WORDS)
    assert [r.documents for r in files.orderBy("start").collect()] == [token_files.FILE_DOCUMENTS, 70_000]
    found = token_files.read(files, str(tmp_path / "short")).agg(F.countDistinct("start"), F.min("start"), F.max("start"), F.sum("n_tokens"))
    assert tuple(found.head()) == (n, 0, n - 1, n)


def test_table_of_files_is_no_file_per_task(spark, docs, tmp_path, monkeypatch):
    kept, materialize = [], token_files.materialize
    monkeypatch.setattr(token_files, "materialize", lambda df, purpose: kept.append(materialize(df, purpose)) or kept[-1])
    small = {"advisoryPartitionSizeInBytes": "1k", "coalescePartitions.minPartitionSize": "1", "coalescePartitions.parallelismFirst": "false"}
    for key, value in small.items():
        spark.conf.set(f"spark.sql.adaptive.{key}", value)
    token_files.write(docs, str(tmp_path / "few"), WORDS)
    for key in small:
        spark.conf.unset(f"spark.sql.adaptive.{key}")
    assert kept[0].select("part").distinct().count() > 1 and len(kept[0].inputFiles()) == 1


def test_empty_table(empty, tmp_path):
    files = token_files.write(empty, str(tmp_path / "none"), WORDS)
    assert files.count() == 0 and token_files.read(files, str(tmp_path / "none")).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        TokenFile(lambda at, n: bytes(n))
    data = b"".join(pack([3], np.array([2], np.uint64), [b"\x01\x00", b"\x02\x00"], "<u2"))
    assert TokenFile(lambda at, n: data[at : at + n]).document(0).tolist() == [1, 2]


def test_query(spark, sf_dir):
    from keyrill.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in QUERIES["op13_elias_fano_ids"](spark, sf_dir).collect())
    assert found == sorted(expected_rows(rows, WORDS))
