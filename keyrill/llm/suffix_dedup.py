"""Removing repeated passages by suffix sorting.

Every byte of a document covered by a string of ``length`` bytes that also starts earlier
(in a smaller document, or in the same one at an earlier place) is removed. Strings never
cross documents and are judged on the input.

A corpus does not fit one suffix array, so it is cut where that loses nothing. The anchor
of a string, the smallest hash of its grams, depends on its bytes alone, so equal strings
meet wherever they are brought together by anchor. Neighbouring strings mostly share an
anchor; such a run, with the bytes of its strings, is the unit. Runs whose anchor's gram
stands once in the corpus hold no repeat. The others are shuffled by anchor, sorted, and read in
blocks; the suffixes of a block are sorted in two stages (``suffixes.sort_suffixes``), and
where neighbours in that order share ``length`` bytes or more, all but the earliest start
are repeats. Equal runs in a block are sorted once.

An anchor with more than ``hot`` runs (a passage in a great part of all documents) would make a
block too large. Its strings are keyed one by one by a 128-bit digest instead and reduced
to the earliest start of each before the shuffle; the rest is the same.

Defined cases: a null text is empty; rows equal in doc_id and text count as one document
and get a row each; documents of one doc_id with different texts go by a hash of the text;
documents without doc_id come after all others. A text below ``length`` bytes has no repeat.
Extra columns pass through ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.llm import suffixes
from keyrill.llm.storage import materialize, passing

LENGTH = 100
HOT = 1 << 18
BLOCK_BYTES = 4 << 20
SCAN_BYTES = 1 << 16
LAST = (1 << 63) - 1
PLACE = np.dtype([("d", "<i8"), ("h", "<i8"), ("start", "<u4")])  # of a run: its document and first byte


def _identified(docs: DataFrame) -> DataFrame:
    """Documents with ``_d`` and ``_h``, their place in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({
        "_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)),
        "_h": F.xxhash64(text),
    })


def _strings(column: pa.Array) -> list[bytes]:
    """The values of a text or binary column as bytes, null as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def _runs(length: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _strings(batch.column("text"))
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size < SCAN_BYTES):
                    size += len(texts[end])
                    end += 1
                block = texts[begin:end]
                ends = np.cumsum([len(t) for t in block])
                start, owned, anchor = suffixes.anchors(np.frombuffer(b"".join(block), np.uint8), ends, length)
                of = np.searchsorted(ends, start, "right")
                lists = np.searchsorted(of, np.arange(len(block) + 1)).astype(np.int32)
                start = start - (ends[of] - np.array([len(t) for t in block], np.int64)[of])

                def listed(values, lists=lists):
                    return pa.ListArray.from_arrays(pa.array(lists), pa.array(values, pa.int64()))

                ids = [batch.column(n).slice(begin, end - begin) for n in ("_u", "_d", "_h")]
                yield pa.RecordBatch.from_arrays(
                    [*ids, listed(anchor), listed(start << 8 | owned)], names=["_u", "_d", "_h", "anchor", "place"]
                )
                begin = end

    return scan


def _contexts(length: int):
    """The bytes of repeated runs, each with the places it has in a batch of documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _strings(batch.column("text"))
            runs = batch.column("runs")
            anchor, place = (runs.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
            of = np.repeat(np.arange(len(texts)), runs.value_lengths().to_numpy(zero_copy_only=False))
            start, owned, hot = place >> 9, place >> 1 & 255, (place & 1).astype(bool)
            d, h = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("_d", "_h"))
            for begin in range(0, len(of), 100_000):
                part = slice(begin, begin + 100_000)
                index: dict[tuple, int] = {}
                keys = zip(
                    anchor[part].tolist(), hot[part].tolist(),
                    (
                        texts[i][s : s + k] for i, s, k in zip(
                            of[part].tolist(), start[part].tolist(), (owned[part] + length - 1).tolist(), strict=True
                        )
                    ), strict=True,
                )
                same = np.fromiter((index.setdefault(k, len(index)) for k in keys), np.int64)
                order = np.argsort(same, kind="stable")
                ends = np.searchsorted(same[order], np.arange(len(index) + 1)).astype(np.int32)
                rows = of[part][order]
                places = np.empty(len(rows), PLACE)
                places["d"], places["h"], places["start"] = d[rows], h[rows], start[part][order]
                sliced = [None, pa.py_buffer(ends * np.int32(PLACE.itemsize)), pa.py_buffer(places.tobytes())]
                anchors, hots, bytes_ = zip(*index, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors, pa.int64()), pa.Array.from_buffers(pa.binary(), len(index), sliced),
                        pa.array(bytes_, pa.binary()), pa.array(hots, pa.bool_()),
                    ],
                    names=["anchor", "places", "bytes", "hot"],
                )

    return cut


def _block_spans(d, h, start, of, context: list[bytes], length: int):
    """Spans of repeats in whole buckets of anchors: arrays (place, begin, end).

    A place (d, h, start) has the bytes ``context[of]``.
    """
    # Documents as numbers in their order, and starts as (document, place) in one number.
    order = np.lexsort((h, d))
    change = np.ones(len(d), bool)
    change[1:] = (d[order][1:] != d[order][:-1]) | (h[order][1:] != h[order][:-1])
    number = np.empty(len(d), np.int64)
    number[order] = np.cumsum(change) - 1
    place = (number << 32) + start

    index: dict[bytes, int] = {}
    same = np.fromiter((index.setdefault(c, len(index)) for c in context), np.int64, len(context))[of]
    distinct = list(index)
    earliest = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(earliest, same, place)

    pad = b"\0" * (length + 8)
    sizes = np.array([len(c) for c in distinct], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(distinct) + b"\0" + pad, np.uint8)
    owned = sizes - length + 1
    holder = np.repeat(np.arange(len(distinct)), owned)
    within = np.arange(len(holder)) - np.repeat(np.cumsum(owned) - owned, owned)
    wanted = begins[holder] + within

    sorted_at = suffixes.sort_suffixes(text, wanted, length)
    groups = np.flatnonzero(suffixes.common_prefix(text, sorted_at, length) < length)
    index_of = np.empty(len(text), np.int32)
    index_of[wanted] = np.arange(len(wanted))
    back = index_of[sorted_at]
    at = earliest[holder[back]] + within[back]
    least = np.minimum.reduceat(at, groups) if len(at) else at
    repeated = np.zeros(len(wanted), bool)
    repeated[back] = at > np.repeat(least, np.diff(np.append(groups, len(at))))

    # Runs of repeated starts in each distinct context, for its earliest occurrence.
    flag = repeated.astype(np.int8)
    begin = np.flatnonzero(flag & ~((np.roll(flag, 1) == 1) & (within > 0)))
    stop = np.flatnonzero(flag & ~((np.roll(flag, -1) == 1) & (within < owned[holder] - 1)))
    first_row = np.full(len(distinct), -1)
    is_first = place == earliest[same]
    first_row[same[is_first]] = np.flatnonzero(is_first)
    rows = first_row[holder[begin]]
    others = np.flatnonzero(~is_first)
    return (
        np.concatenate([rows, others]),
        np.concatenate([start[rows] + within[begin], start[others]]),
        np.concatenate([start[rows] + within[stop] + length, start[others] + sizes[same[others]]]),
    )


def _sorted_blocks(length: int, block_bytes: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def spans(table: pa.Table) -> pa.RecordBatch:
            lists = table.column("places").to_pylist()
            places = np.frombuffer(b"".join(lists), PLACE)
            of = np.repeat(np.arange(len(lists)), [len(p) // PLACE.itemsize for p in lists])
            d, h, start = (np.ascontiguousarray(places[n], np.int64) for n in PLACE.names)
            row, begin, end = _block_spans(d, h, start, of, table.column("bytes").to_pylist(), length)
            return pa.RecordBatch.from_arrays(
                [pa.array(d[row]), pa.array(h[row]), pa.array(begin), pa.array(end)],
                names=["_d", "_h", "begin", "end"],
            )

        for batch in batches:
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size < block_bytes:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("anchor").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last anchor may go on in the next batch
            if cut:
                yield spans(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(b.column("bytes").nbytes for b in held)
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows:
                yield spans(table)

    return find


def _string_digests(length: int):
    """Every string of a run by its digest, for anchors with too many runs for a block."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                context = batch.column("bytes")[row].as_py()
                n = len(context) - length + 1
                digests = pa.array([hashlib.blake2b(context[i : i + length], digest_size=16).digest() for i in range(n)], pa.binary())
                for d, h, start in np.frombuffer(batch.column("places")[row].as_py(), PLACE).tolist():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, d)), pa.array(np.full(n, h)), pa.array(np.arange(start, start + n)), digests],
                        names=["_d", "_h", "at", "digest"],
                    )

    return keyed


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (_d, _h, spans): the byte spans [begin, end) of repeats in each document that has any; they may overlap."""
    runs, drop_runs = passing(
        docs.select(F.monotonically_increasing_id().alias("_u"), "_d", "_h", "text")
        .mapInArrow(_runs(length), "_u long, _d long, _h long, anchor array<long>, place array<long>"),
        "suffix-runs",
    )
    repeated = materialize(
        runs.select(F.explode("anchor").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("anchor", (F.col("n") > hot).alias("hot")),
        "suffix-anchors",
    )
    # A run as its anchor and one number: start, number of strings, and whether the anchor is hot. Written, so that neither
    # all runs nor their shuffles are on disk along with the contexts.
    flagged = materialize(
        runs.select("_u", F.explode(F.arrays_zip("anchor", "place")).alias("r"))
        .select("_u", F.col("r.anchor").alias("anchor"), F.col("r.place").alias("place"))
        .join(repeated, "anchor")
        .select("_u", "anchor", (2 * F.col("place") + F.col("hot").cast("int")).alias("place"))
        .groupBy("_u").agg(F.collect_list(F.struct("anchor", "place")).alias("runs"))
        .join(runs.groupBy("_d", "_h").agg(F.min("_u").alias("_u")), "_u")  # equal rows have the same runs
        .select("_d", "_h", "runs"),
        "suffix-flagged",
    )
    drop_runs()
    # The texts are shuffled here and once more where spans are applied, by the same keys and with
    # the same columns, so that one exchange serves both.
    contexts = docs.join(flagged, ["_d", "_h"]).mapInArrow(
        _contexts(length), "anchor long, places binary, bytes binary, hot boolean"
    )
    if repeated.filter("hot").limit(1).count():
        contexts = materialize(contexts, "suffix-contexts")
        strings = contexts.filter("hot").select("places", "bytes").mapInArrow(_string_digests(length), "_d long, _h long, at long, digest binary")
        place = F.struct("_d", "_h", "at")
        least = strings.groupBy("digest").agg(F.min(place).alias("least"))
        more = strings.join(least, "digest").filter(place > F.col("least")).select(
            "_d", "_h", F.col("at").alias("begin"), (F.col("at") + length).alias("end")
        )
        contexts = contexts.filter("not hot")
    else:
        more = None
    found = (
        contexts.drop("hot").repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_sorted_blocks(length, block_bytes), "_d long, _h long, begin long, end long")
    )
    if more is not None:
        found = found.unionByName(more)
    return found.groupBy("_d", "_h").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _merged(spans) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for begin, end in sorted(spans or ()):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([begin, end])
    return [(b, e) for b, e in merged]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for begin, end in spans:
        parts.append(text[at:begin])
        at = end
    return b"".join([*parts, text[at:]])


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in to whole characters, so that what is kept is UTF-8."""
    inner = []
    for begin, end in spans:
        while begin < end and text[begin] & 0xC0 == 0x80:
            begin += 1
        while end > begin and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if begin < end:
            inner.append((begin, end))
    return inner


def _apply(names: list[str], digest: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _strings(batch.column("text"))
            spans = [
                _merged([(s["begin"], s["end"]) for s in row] if row else None)
                for row in batch.column("spans").to_pylist()
            ]
            if not digest:
                spans = [_whole_characters(t, s) for t, s in zip(texts, spans, strict=True)]
            kept = [_kept(t, s) for t, s in zip(texts, spans, strict=True)]
            counts = [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([sum(e - b for b, e in s) for s in spans], pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
            ]
            if digest:
                columns = [batch.column("doc_id"), *counts, pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            else:
                columns = [pa.array(kept, pa.binary()).cast(pa.string()) if n == "text" else batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, *counts], names=[*names, "n_bytes", "n_removed", "n_spans"])

    return remove


def suffix_digest(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """A row per document: its bytes, how many of them go, in how many spans, and a digest of the rest."""
    marked = _identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    spans = repeated_spans(marked, length, **options)
    return marked.join(spans, ["_d", "_h"], "left").mapInArrow(
        _apply([], True), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def dedup(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """``docs`` with repeats cut out of ``text``, and ``n_bytes``, ``n_removed``, ``n_spans``.

    Removed spans are drawn in to whole characters.
    """
    names = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans")]
    marked = _identified(docs.select(*names))
    spans = repeated_spans(marked, length, **options)
    joined = marked.join(spans, ["_d", "_h"], "left")
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return joined.mapInArrow(
        _apply(names, False), f"{kinds}, n_bytes long, n_removed long, n_spans long"
    )
