"""Near copies by a byte-position index of signatures with count filtering, a complete index of what it leaves, and exact word-shingle Jaccard.

Two documents are linked if the Jaccard similarity of their sets of ``SHINGLE``-word shingles is
``LEAST`` or more; a text of fewer words is one shingle, and ASCII letters fold case. A signature has a byte for each of
``POSITIONS`` minimum hashes, so two signatures agree in a position with the similarity of their sets, or by chance of 1 in 256. The
index posts a signature under ``GROUP`` neighbouring positional bytes at a time: a pair at 0.8 shares no list with
probability (1 - 0.8^4)^20, 3 in 100,000. Pairs of a list are tallied over all positions and kept from ``MINIMUM`` equal bytes on, which a pair at 0.8
reaches with probability 0.997 (binomial). Of those, a pair is compared by its sets of shingle hashes, so no link is wrong, unless its odd
sketches rule it out: a sketch has the parity of the number of shingles in each of some buckets, so two sets differ in at least as
many shingles as their sketches in bits, and at 0.8 in no more than a ninth of both sizes together. This loses no link, and keeps a group of many texts
just under the similarity from being compared in all pairs. Eight bytes of
a SimHash cannot stand in for the signature: at 0.8 fingerprints differ in ten of 64 bits on average, so no byte need be shared.

Documents with equal sets are one node, whatever their number. In each of ``ROUNDS`` rounds, a list's nodes meet by a
hash, ``BLOCK`` at a time, and each tries only its best-tallied partner of another component; so a large group of near copies
becomes one component by about as many checks as it has nodes. Then the pairs above the minimum that still lie in two components are checked,
each in the first list it shares. They are found inside tasks, by pairs of blocks, so a long list is neither joined with itself nor held by one task.

Signatures miss a pair at 0.8 now and then, so nodes meet once more in lists that no linked pair can avoid (``posts``). Sets of sizes a and b at 0.8 differ in at most (a + b) / 9
shingles; cut the hashes into more ranges than that, and the sets are equal in one range at least. A node is posted under the sum of its shingles in each range, for
the classes of sizes its partners may have. Only lists whose nodes lie in two components are kept, and of their pairs those that sizes and odd sketches allow are compared, so no pair is lost.

Defined cases: texts that are null, empty or of white space only are one node; very long texts are hashed whole, a few thousand
shingles at a time; rows with equal doc_id keep a row each while deciding, and each component keeps one of its own; rows without doc_id follow the others of their component; an
empty table gives no rows. Extra columns pass through ``near_dedup``, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.components import components
from keyrill.llm.storage import materialize, set_aside

SHINGLE = 5
LEAST = (4, 5)
POSITIONS = 80
GROUP = 4
MINIMUM = 54
ROUNDS = 2
BLOCK = 512
BUCKETS = (1 << 6, 1 << 13)  # of an odd sketch, least and most; else two a shingle or more
POSTS_PER_PART = 1 << 21  # posts that are brought together in one task
MAX_BROADCAST = 1 << 20  # rows
SEED = 42

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, POSITIONS, np.uint64)

# Sizes at which a class begins; each is a quarter longer than the one before. Fewer shingles than four have no partner but equal sets.
_CLASSES = [1, 4]
while _CLASSES[-1] < 1 << 40:
    _CLASSES.append(max(_CLASSES[-1] + 1, _CLASSES[-1] * 5 // 4))


def grams(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[-n:].tolist(), strict=True)], np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """A byte for each position of a set of hashes."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 11):  # bounded memory for very long texts
        mixed = (hashes[at : at + (1 << 11), None] ^ _SHIFTS) * _FACTORS
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, mixed.min(0))
    return (least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each bucket, packed; the number of buckets is a power of two."""
    least, most = BUCKETS
    n = min(max(least, 1 << (2 * len(hashes) - 1).bit_length()), most)
    return np.packbits((np.bincount((hashes & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8))


def _mixed(numbers: np.ndarray) -> np.ndarray:
    mixed = (numbers ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed ^ mixed >> np.uint64(29)


def posts(hashes: np.ndarray) -> np.ndarray:
    """Numbers of the lists of a sorted set of hashes; two sets with a similarity of ``LEAST`` or more are equal or share one.

    In the class of the smaller set, which both are posted in, the sets differ in no more than ``differ`` ranges. A set with no more than so many
    ranges that hold any shingle is posted under its empty ranges too: if that is so for both sets they may share no other.
    """
    part, whole = LEAST
    n, sums = len(hashes), np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(hashes), dtype=np.uint64)])
    first, last = (bisect.bisect_right(_CLASSES, size) - 1 for size in (-(-part * n // whole), n))
    found = []
    for at in range(max(first, 1), last + 1):
        longest = _CLASSES[at + 1] - 1
        differ = (longest + whole * longest // part) * (whole - part) // (whole + part)
        ranges = differ + 1 + (differ + 1) // 12 + 1  # some are empty
        places = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        bounds = np.searchsorted(places, np.arange(ranges + 1, dtype=np.uint64))
        held = bounds[1:] > bounds[:-1]
        kept = np.flatnonzero(held) if held.sum() > differ else np.arange(ranges)
        place = _mixed((np.uint64(at) << np.uint64(48)) + kept.astype(np.uint64))
        found.append(_mixed((sums[bounds[kept + 1]] - sums[bounds[kept]]) ^ place))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _folded(sketches: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Bytes of each sketch, and by each such length the sketches of that length or more, folded to it: a row each."""
    sizes = np.array([len(s) for s in sketches])
    tables = {}
    for size in np.unique(sizes).tolist():
        table = np.zeros((len(sketches), size), np.uint8)
        for i in np.flatnonzero(sizes >= size):  # a bucket's parity is that of the buckets which fall into it
            table[i] = np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint8).reshape(-1, size), 0)
        tables[size] = table.view(np.uint64)
    return sizes, tables


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, signatures, sketches = [], [], [], []
        for text in batch.column("text"):
            found = grams(text.as_py())
            nodes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
            sizes.append(len(found))
            signatures.append(signature(found).tobytes() if len(found) else None)
            sketches.append(odd_sketch(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("row"), pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(sketches, pa.binary()),
            ],
            names=["doc_id", "row", "node", "size", "signature", "odd"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [grams(t.as_py()).view(np.int64) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "grams"])


def _posted(parts: int):
    """Posts of the texts of a batch by part of the lists, a row each: low halves of their numbers, their nodes, and which of these each is of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {}
            for text in batch.column("text"):
                found = grams(text.as_py())
                node = xxhash.xxh64_intdigest(found.tobytes(), SEED)
                if node not in made:
                    made[node] = posts(found)
            if not made or not (numbers := np.concatenate([*made.values()])).size:
                continue
            nodes = np.array([*made], np.uint64).view(np.int64)
            of = np.repeat(np.arange(len(made), dtype=np.uint32), [len(m) for m in made.values()])
            place = ((numbers >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(place, kind="stable")
            here, starts = np.unique(place[order], return_index=True)
            for number, chosen in zip(here.tolist(), np.split(order, starts[1:]), strict=True):
                used, which = np.unique(of[chosen], return_inverse=True)
                packed = [numbers[chosen].astype(np.uint32), nodes[used], which.astype(np.uint32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in packed]],
                    names=["part", "marks", "nodes", "which"],
                )

    return run


def _together(rows: pa.Table) -> pa.Table:
    """The lists (key, node) of a part that have two nodes or more."""
    part = rows.column("part")[0].as_py()
    marks = np.concatenate([np.frombuffer(m, np.uint32) for m in rows.column("marks").to_pylist()])
    node = np.concatenate([
        np.frombuffer(n, np.int64)[np.frombuffer(w, np.uint32)]
        for n, w in zip(rows.column("nodes").to_pylist(), rows.column("which").to_pylist(), strict=True)
    ])
    order = np.argsort(marks, kind="stable")
    marks, node = marks[order], node[order]
    again = marks[1:] == marks[:-1]
    shared = np.concatenate([again, [False]]) | np.concatenate([[False], again])
    marks, node = marks[shared], node[shared]
    order = np.lexsort((node, marks))
    marks, node = marks[order], node[order]
    if len(marks):  # a node is in a list once
        once = np.concatenate([[True], (marks[1:] != marks[:-1]) | (node[1:] != node[:-1])])
        marks, node = marks[once], node[once]
        again = marks[1:] == marks[:-1]
        shared = np.concatenate([again, [False]]) | np.concatenate([[False], again])
        marks, node = marks[shared], node[shared]
    return pa.table({"key": pa.array(marks.astype(np.int64) + (part << 32), pa.int64()), "node": pa.array(node, pa.int64())})


def _small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _placed(df: DataFrame, linked: DataFrame | None) -> DataFrame:
    """``df`` (node, ...) with the component of each node."""
    if linked is None:
        return df.withColumn("component", F.col("node"))
    return df.join(_small(linked), "node", "left").withColumn("component", F.coalesce("component", "node"))


def apart(slim: DataFrame, nodes: DataFrame, linked: DataFrame | None) -> DataFrame:
    """Nodes by list as ``candidates`` takes them, of the lists of ``posts`` with nodes of two components; a group of -1 stands for these lists."""
    shingles = nodes.agg(F.sum("size")).head()[0] or 0
    parts = max(1, -(-shingles * 6 // 10 // POSTS_PER_PART))
    posted = slim.select("text").mapInArrow(_posted(parts), "part long, marks binary, nodes binary, which binary")
    met = materialize(posted.groupBy("part").applyInArrow(_together, "key long, node long"), "near-copies-met")
    thin = _placed(met, linked)
    live = thin.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("key")
    rows = thin.join(_small(materialize(live, "near-copies-live")), "key", "left_semi").join(nodes.select("node", "size", "odd"), "node")
    none = F.lit("").cast("binary").alias("signature")
    return materialize(rows.select(F.lit(-1).alias("group"), "key", "node", "size", "component", none, "odd"), "near-copies-apart")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) of nodes whose sets of shingles have a Jaccard similarity of ``LEAST`` or more."""
    part, whole = LEAST
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("_x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("grams").alias("_y")), "b"
    )
    shared = F.size(F.array_intersect("_x", "_y"))
    return both.filter(whole * shared >= part * (F.size("_x") + F.size("_y") - shared)).select("a", "b")


def _met(members: pa.StructArray, side: np.ndarray, group: int, best: bool) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (a, b) of a list's block, or of two blocks told apart by ``side``, that reach the minimum.

    They are of two components, and of sizes and odd sketches that allow the similarity. With ``best`` a node is given with one partner only,
    else a pair is given in the first group of positions in which it agrees. Lists of no such group (-1) have no signatures and no minimum.
    """
    part, whole = LEAST
    node, size, component = (members.field(n).to_numpy(zero_copy_only=False) for n in ("node", "size", "component"))
    signs = np.frombuffer(b"".join(members.field("signature").to_pylist()), np.uint8).reshape(-1, POSITIONS)
    words = np.ascontiguousarray(signs).view(np.uint32)  # a number for each group of positions
    widths, tables = _folded(members.field("odd").to_pylist())
    two = side.min() != side.max()
    first, second = [], []
    for i in range(len(node)):
        if two and side[i]:
            continue
        others = np.arange(len(node)) if best else np.flatnonzero(side == 1) if two else np.arange(i + 1, len(node))
        fits = whole * np.minimum(size[others], size[i]) >= part * np.maximum(size[others], size[i])
        others = others[fits & (component[others] != component[i])]
        if not len(others):
            continue
        tally = (signs[others] == signs[i]).sum(1) if group >= 0 else np.full(len(others), MINIMUM)
        if not best and group >= 0:
            tally[(words[others] == words[i]).argmax(1) != group] = 0
        others, tally = others[tally >= MINIMUM], tally[tally >= MINIMUM]
        differ = np.zeros(len(others), np.int64)
        width = np.minimum(widths[others], widths[i])
        for w in np.unique(width).tolist():
            at = width == w
            differ[at] = np.bitwise_count(tables[w][others[at]] ^ tables[w][i]).sum(1)
        alike = (whole + part) * differ <= (whole - part) * (size[others] + size[i])
        others, tally = others[alike], tally[alike]
        if best and len(others):
            others = others[tally.argmax()][None]
        first.append(np.full(len(others), node[i]))
        second.append(node[others])
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(first), np.concatenate(second)
    return np.minimum(a, b), np.maximum(a, b)


def _pairs(best: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, groups = batch.column("members"), batch.column("group").to_pylist()
            for row, group in enumerate(groups):
                members = lists[row].values
                a, b = _met(members, members.field("side").to_numpy(zero_copy_only=False), group, best)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def candidates(now: DataFrame, turn: int | None) -> DataFrame:
    """Pairs (a, b) of the lists of ``now`` to be checked: of a round, or all that are left (None)."""
    lists = now.groupBy("group", "key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")
    ).filter("x != y").select("group", "key", "blocks")
    live = now.join(lists, ["group", "key"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(turn or 0)), "blocks"))
    member = ["node", "size", "component", "signature", "odd"]
    if turn is None:  # each block with itself and every other one
        turns = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: F.struct(
            F.least("block", other).alias("i"), F.greatest("block", other).alias("j"), (F.col("block") > other).cast("int").alias("side")
        ))
        live = live.select("group", "key", *member, F.explode(turns).alias("_t")).select("group", "key", *member, "_t.*")
    else:
        live = live.select("group", "key", *member, F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"))
    met = live.groupBy("group", "key", "i", "j").agg(F.collect_list(F.struct(*member, "side")).alias("members")).filter(F.size("members") > 1)
    return met.select("group", "members").mapInArrow(_pairs(turn is not None), "a long, b long").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, row (a hash of its text), component, component_id (its smallest doc_id)."""
    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), "text")
    schema = "doc_id long, row long, node long, size long, signature binary, odd binary"
    marked = materialize(slim.mapInArrow(_marked, schema), "near-copies")
    nodes = marked.filter(F.col("signature").isNotNull()).groupBy("node").agg(
        F.min("row").alias("row"), F.min("size").alias("size"), F.first("signature").alias("signature"), F.first("odd").alias("odd")
    )
    keys = F.transform(F.sequence(F.lit(0), F.lit(POSITIONS // GROUP - 1)), lambda k: F.substring("signature", k * GROUP + 1, F.lit(GROUP)))
    posted = nodes.select("node", F.posexplode(keys).alias("group", "key"))
    shared = posted.groupBy("group", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("group", "key")
    # Nodes that meet another one, by list.
    places = posted.join(shared, ["group", "key"], "left_semi")
    met = materialize(places.join(nodes.select("node", "size", "signature", "odd"), "node"), "near-copies-lists")

    def sets_of(chosen: DataFrame) -> DataFrame:
        wanted = nodes.join(chosen, "node", "left_semi").select("node", "row")
        texts = slim.select("row", "text").join(wanted, "row").dropDuplicates(["node"]).select("node", "text")
        return materialize(texts.mapInArrow(_sets, "node long, grams array<long>"), "near-copies-sets")

    sets = sets_of(met.select("node").distinct())
    links = linked = None
    now = met.withColumn("component", F.col("node"))
    for turn in [*range(ROUNDS), None, "apart"]:
        if turn == "apart":
            now, turn = apart(slim, nodes, linked), None
            pairs = materialize(candidates(now, turn), "near-copies-pairs")
            sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        else:
            pairs = materialize(candidates(now, turn), "near-copies-pairs")
        found = materialize(similar(pairs, sets), "near-copies-links")
        if not found.head(1):
            continue
        links = found if links is None else links.unionByName(found)
        linked = components(links)
        now = met.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = _placed(marked.select("doc_id", "row", "node"), linked)
    ids = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return materialize(placed.join(ids, "component").select("doc_id", "row", "component", "component_id"), "near-copies-classes")


def near_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component kept: the one with the smallest doc_id.

    Of the component's rows with that doc_id, one with the smallest text stays. In a
    component without any doc_id one row stays likewise.
    """
    held, column = set_aside(docs, ["doc_id", "text"])
    # Rows of one doc_id and text go by their other columns, as text, in the order of their names' places.
    order = ["text", *[column(c).cast("string") for c in docs.columns if c.lower() not in ("doc_id", "text")]]
    found = classes(held)
    # A doc_id may come in several components.
    heads = found.filter(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("_head"), F.col("row").alias("_row"), F.col("component").alias("_c")
    ).distinct()
    kept = held.join(heads, (F.col("doc_id").cast("long") == F.col("_head")) & (F.xxhash64("text") == F.col("_row")))
    once = Window.partitionBy("_c").orderBy(*order)
    names = held.columns
    kept = kept.withColumn("_n", F.row_number().over(once)).filter("_n = 1").select(*names)
    nameless = found.filter(F.col("doc_id").isNull() & F.col("component_id").isNull()).select(
        F.col("row").alias("_row"), F.col("component").alias("_c")
    ).distinct()
    if nameless.limit(1).count():
        alone = held.filter(F.col("doc_id").isNull()).join(nameless, F.xxhash64("text") == F.col("_row"))
        first = Window.partitionBy("_c").orderBy(*order)
        kept = kept.unionByName(alone.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(*names))
    return kept.select(*[column(c) for c in docs.columns])
