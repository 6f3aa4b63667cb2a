import zlib

import numpy as np

from keyrill.llm import langid
from keyrill.llm.queries import op10_kernel_language


def test_query(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op10_kernel_language(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(langs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_labels_outside_the_training_fold_do_not_matter(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    swapped = docs.selectExpr(
        "doc_id", "text", "if(crc32(cast(doc_id as string)) % 3 = 1, 'zz', lang) as lang", "'s' as source", "n_chars"
    )
    a = {r.doc_id: r.lang_pred for r in langid.language_digest(docs).collect()}
    b = {r.doc_id: r.lang_pred for r in langid.language_digest(swapped).collect()}
    assert a == b


def test_edge_cases(spark, docs, rows, empty):
    found = langid.language_digest(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[d].lang_pred == "und" and by_id[d].score == 0 for d in (140, 141, 142))
    assert {r.lang_pred for r in found} <= {"en", "de", "und"}
    assert langid.language_digest(empty).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.language_digest(unlabelled).collect()} == {"und"}
    nameless = spark.createDataFrame([(None, "12 34 !", "en"), (None, "½", "en")], "doc_id long, text string, lang string")
    assert [(r.held_out, r.lang_pred) for r in langid.language_digest(nameless).collect()] == [(False, "und")] * 2


def test_scores_are_the_kernel_ridge(spark):
    """The folded matrix gives what kernels to the landmarks, mapped and weighted, give."""
    texts = [("en", "the cat sat"), ("en", "the dog ran"), ("de", "der hund lief"), ("de", "die katze sass")]
    flags = [langid.presence(t) for _, t in texts]
    languages, matrix = langid.train([(lang, np.packbits(f).tobytes()) for (lang, _), f in zip(texts, flags, strict=True)], ridge=1e-6)
    scores = np.array([f / np.sqrt(f.sum()) for f in flags]) @ matrix
    assert [languages[k] for k in scores.argmax(1)] == [lang for lang, _ in texts]
    assert np.allclose(scores, [[lang == k for k in languages] for lang, _ in texts], atol=1e-3)


def test_one_off_labels_do_not_take_the_query_down(spark):
    """Of 620 labels the most frequent 512 are taught; the large ones are among them."""
    words = {"en": "the cat sat on the mat and looked at it", "de": "der hund lief durch die straße und über das feld"}
    rows = [(i, f"{words[lang]} {i % 40}", lang) for i in range(400) for lang in [("en", "de")[i % 2]]]
    rows += [(1000 + i, f"zzq{i:04d} qxq", f"tag{i:04d}") for i in range(618)]
    found = langid.language_digest(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(found) == len(rows)
    large = [r for r in found if r.doc_id < 1000]
    assert all(r.lang_pred == ("en", "de")[r.doc_id % 2] for r in large)
    labels = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").select("lang", "text"))
    assert len({lang for lang, _ in labels}) == 512 and len(labels) <= langid.SAMPLE
