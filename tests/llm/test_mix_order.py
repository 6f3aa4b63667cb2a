import corpus_pipeline
import pytest
from test_packing import check

from keyrill.llm import mixing, packing
from keyrill.llm.queries import TOKENIZER


def test_weights_change_the_rows_of_run(spark, sf_dir, monkeypatch):
    """The last two stages, as run() has them, over the written documents of the stage before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def rows(weights):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        found = docs
        for _, stage in corpus_pipeline.STAGES[-2:]:
            found = corpus_pipeline.materialize(stage(spark, found, sf_dir), "stage")
        return {(r.doc_id, r.piece): (r.sequence_id, r.offset) for r in found.collect()}

    def rows_without_mix():
        found = corpus_pipeline.materialize(docs, "stage")
        return {(r.doc_id, r.piece): (r.sequence_id, r.offset) for r in corpus_pipeline.packed(spark, found, sf_dir).collect()}

    monkeypatch.setattr(corpus_pipeline, "MIX_WINDOW", 1 << 15)
    source = docs.select("source").orderBy("source").head().source
    plain, again, tilted = rows(None), rows(None), rows({source: 1.0})
    assert plain == again
    assert plain.keys() == tilted.keys() and plain != tilted
    without = rows_without_mix()
    assert plain.keys() == without.keys() and plain != without


@pytest.mark.parametrize("slot", [3, 65_536])
def test_sequences_follow_the_slots(docs, rows, slot):
    mixed = mixing.mix(docs, block_bytes=700, period=11, chunks=4)
    found = packing.pack_in_order(mixed, TOKENIZER, "slot", 4, capacity=64, pieces_per_slot=slot).collect()
    check([(r[0], r[1]) for r in rows], found, 64)
    window = {}
    for r in mixed.collect():
        window.setdefault(r.doc_id, set()).add(r.slot // 4)
    last = -1
    by_sequence = {}
    for r in found:
        if len(window[r.doc_id]) == 1:
            by_sequence.setdefault(r.sequence_id, set()).update(window[r.doc_id])
    for sequence in sorted(by_sequence):
        assert len(by_sequence[sequence]) == 1
        assert max(by_sequence[sequence]) >= last
        last = max(by_sequence[sequence])
    assert last > 0


def test_sequences_follow_the_files(spark, docs, rows):
    """Windows of tokens by the order of rows in files, also of documents that are in no file yet."""
    written = packing.materialize(docs.repartition(3), "docs")
    order = written.select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    found = packing.pack_as_written(written, TOKENIZER, 300, capacity=64).collect()
    check([(r[0], r[1]) for r in rows], found, 64)
    length = {}
    for r in found:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    window, total = {}, 0
    for r in sorted(order, key=lambda r: (r.file_name, r.row_index)):
        if r.doc_id == 5:  # a repeated row
            total += length[5] // 2
            continue
        window[r.doc_id] = (total // 300, (total + length[r.doc_id] - 1) // 300)
        total += length[r.doc_id]
    sequences = {}
    for r in found:
        if r.doc_id in window and window[r.doc_id][0] == window[r.doc_id][1]:
            sequences.setdefault(r.sequence_id, set()).add(window[r.doc_id][0])
    assert all(len(w) == 1 for w in sequences.values())
    in_order = [min(sequences[s]) for s in sorted(sequences)]
    assert in_order == sorted(in_order) and in_order[-1] > 0
    check([(r[0], r[1]) for r in rows], packing.pack_as_written(docs, TOKENIZER, 300, capacity=64).collect(), 64)


def test_empty(empty):
    assert packing.pack_in_order(mixing.mix(empty), TOKENIZER, "slot", 4).collect() == []
    assert packing.pack_as_written(empty, TOKENIZER, 300).collect() == []
