import corpus_pipeline
from keyrill.llm import quality, suffix_dedup
from test_near_copies import expected


def test_stages(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir)
        assert docs.columns == names
        kept.append((before, docs))

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = {r.doc_id: r.kept for r in quality.quality_digest(kept[0][0], labels).collect()}
    assert sorted(r.doc_id for r in kept[0][1].collect()) == sorted(d for d, k in judged.items() if k)

    near = [(r.doc_id, r.text) for r in kept[1][0].collect()]
    assert sorted(r.doc_id for r in kept[1][1].collect()) == expected(near)

    removed = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.suffix_digest(kept[2][0]).collect()}
    after = {r.doc_id: r for r in kept[2][1].collect()}
    for doc_id, (size, gone) in removed.items():
        left = len(after[doc_id].text.encode()) if doc_id in after else 0
        assert size - gone <= left <= size - gone + 8 * 4 * 10 or doc_id not in after
        assert doc_id in after or gone
    assert all(r.n_chars == len(r.text) for r in after.values())

    assert sorted(r.doc_id for r in kept[3][1].collect()) == sorted(after)


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    room = {}
    for r in packed:
        assert len(r.ids) == r.length
        room[r.sequence_id] = room.get(r.sequence_id, 0) + r.length
    assert max(room.values()) <= 2048
    assert sum(room.values()) >= 0.95 * 2048 * len(room) - 2048
