"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints of 64 bits are eight positional bytes. Two that differ in at most ``distance``
bits differ in at most as many bytes, so they share at least ``8 - distance`` positional
bytes. The index posts each distinct fingerprint under its positional bytes, as many of
them together as that guaranteed minimum (each choice of five positions, for distance 3):
two fingerprints meet in a posting list exactly if their tally of shared bytes reaches the
minimum. Posting lists of single bytes would give the same pairs, but each would
hold a 256th of all fingerprints, which grows with the square of the corpus. The pairs of a
list are tallied over all eight positions, kept from the minimum on, and verified by
their differing bits.

Documents with the same fingerprint are one entry of the index, whatever their number. A
list fixes five bytes, so it holds at most 2^24 fingerprints; in a long one, each looks up
its 2,324 possible neighbours (all changes of up to three of the free bits) instead of
meeting all others. A list gives links from each fingerprint to one other of its group, not
all pairs, and the components are found over those.

Defined cases: a null or empty text, or one of white space only, has fingerprint zero and links
like any other; rows with equal doc_id keep a row each; rows without doc_id get a component id
from the others of their component, null if there is none. Extra columns pass through
``near_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.components import components
from keyrill.llm.storage import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 3
DENSE = 2_324


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text over its word shingles, repeats counted; ASCII letters fold case."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)], strict=True)],
            ">u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(names: list[str], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column("text")), np.uint64, batch.num_rows
            )
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values.view(np.int64))], names=[*names, "fp"])

    return run


def _postings(distance: int) -> Column:
    """Per choice of positions, its number above the positional bytes chosen, as one key."""
    keys = []
    for number, places in enumerate(combinations(range(8), 8 - distance)):
        mask = sum(0xFF << (8 * p) for p in places)
        mask -= (mask >> 63) << 64  # as a signed number
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*keys)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def list_links(members: np.ndarray, distance: int, dense: int = DENSE) -> list[tuple[int, int]]:
    """Links between the fingerprints of a posting list: each one to one smaller of its group."""
    members = np.unique(members)
    size = len(members)
    label = np.arange(size)

    def joined(a: np.ndarray, b: np.ndarray) -> None:
        """Labels become equal along the given pairs."""
        nonlocal label
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = new[new]
            new = new[label]
            if np.array_equal(new, label):
                return
            label = new

    need = 8 - distance
    if size <= dense:
        pairs_a, pairs_b = [], []
        for i in range(size - 1):
            differ = members[i + 1 :] ^ members[i]
            shared = (differ[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8)) & np.uint64(0xFF) == 0).sum(1)
            near = np.flatnonzero((shared >= need) & (_bits(differ) <= distance))
            pairs_a.append(np.full(len(near), i))
            pairs_b.append(near + i + 1)
        joined(np.concatenate(pairs_a), np.concatenate(pairs_b))
    else:
        free = np.bitwise_or.reduce(members ^ members[0])
        bits = [np.uint64(1 << b) for b in range(64) if int(free) >> b & 1]
        for changed in range(1, distance + 1):
            for chosen in combinations(bits, changed):
                other = members ^ np.bitwise_or.reduce(np.array(chosen))
                at = np.minimum(np.searchsorted(members, other), size - 1)
                hit = np.flatnonzero((members[at] == other) & (other > members))
                if len(hit):
                    joined(hit, at[hit])
    linked = np.flatnonzero(label != np.arange(size))
    signed = members.view(np.int64)
    return list(zip(signed[label[linked]].tolist(), signed[linked].tolist(), strict=True))


def _links(distance: int, dense: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            lists = batch.column("fps")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(sizes)
            pairs = np.flatnonzero(sizes == 2)  # most lists: no loop for these
            a, b = values[ends[pairs] - 2], values[ends[pairs] - 1]
            near = (a != b) & (_bits(a ^ b) <= distance)
            found += zip(a[near].view(np.int64).tolist(), b[near].view(np.int64).tolist(), strict=True)
            for row in np.flatnonzero(sizes > 2):
                found += list_links(values[ends[row] - sizes[row] : ends[row]], distance, dense)
            first, second = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["a", "b"])

    return run


def links(fingerprints: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Links (a, b) that connect all fingerprints (``fp``) within ``distance`` bits of each other."""
    if not 0 < distance < 8:
        raise ValueError("distance must be between 1 and 7")
    posted = (
        fingerprints.select("fp").distinct()
        .select("fp", F.explode(_postings(distance)).alias("key"))
        .groupBy("key").agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1).select("fps")
    )
    return posted.mapInArrow(_links(distance, dense), "a long, b long").distinct()


def classes(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """A row per document: doc_id, fp (the fingerprint as a signed number), component_id."""
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    marked = materialize(slim.mapInArrow(_fingerprints(["doc_id"], shingle), "doc_id long, fp long"), "simhash")
    groups = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    linked = components(links(groups, distance))
    placed = groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(ids, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    """A row per document: its fingerprint as 16 hex digits and the smallest doc_id of its component."""
    return classes(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component kept: the one with the smallest doc_id.

    Of rows with that doc_id, those with the smallest text stay; of equal ones, one. In a
    component without any doc_id one row stays likewise.
    """
    names = docs.columns
    found = classes(docs, distance, shingle)
    # A component has one row with its smallest doc_id, or several if doc_ids repeat.
    heads = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(heads.withColumnRenamed("doc_id", "_head"), F.col("doc_id").cast("long") == F.col("_head"), "left_semi")
    once = Window.partitionBy("doc_id").orderBy("text", *[c for c in names if c not in ("doc_id", "text")])
    kept = kept.withColumn("_n", F.row_number().over(once)).filter("_n = 1").select(*names)
    nameless = found.filter(F.col("doc_id").isNull() & F.col("component_id").isNull()).select("fp").distinct()
    if nameless.limit(1).count():
        slim = docs.filter(F.col("doc_id").isNull())
        marked = slim.mapInArrow(
            _fingerprints(names, shingle), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", fp long"
        )
        linked = components(links(found, distance))
        alone = marked.join(nameless, "fp", "left_semi").join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        alone = alone.withColumn("_c", F.coalesce("component", "fp"))
        first = Window.partitionBy("_c").orderBy("text", *[c for c in names if c not in ("doc_id", "text")])
        kept = kept.unionByName(alone.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(*names))
    return kept
