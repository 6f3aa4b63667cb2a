"""Best-fit packing by length patterns.

Documents become pieces of at most ``capacity`` tokens, pieces become a histogram of
lengths, and the histogram is packed, not the pieces: patterns of one to three lengths
that fill a sequence exactly are enumerated, their repeat counts are fitted to the
histogram by non-negative least squares (accelerated projected gradient), rounded along
their running sum and cut to what the histogram holds; what is left is packed best-fit
from the longest length down, whole groups of equal pieces at a time. The plan is a table of
runs (length, first rank, count, first sequence, offset). Its size depends on the number
of lengths, ``capacity`` at most, never on the corpus, so it is made on the driver and broadcast.
A piece finds its place by its length and its rank among pieces of that length.

``pack_in_order`` does the same for each window of an order column, so that sequences follow that order, and
``pack_as_written`` for windows of tokens in the order of the files. Both rank rows without ids and join the ids once.

Tokenizing, ranking and placing are distributed. Ranks come from counts per (length, slot)
with slots of a bounded number of pieces, so a common length is not ranked by one task.

Defined cases: a null or empty text is the end mark alone; null doc_ids and repeated rows are
documents of their own (repeated rows are told apart by a running number); control strings
in a text are ordinary text; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize

CAPACITY = 2048
END_ID = 0
PIECES_PER_SLOT = 4_096
PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]

# The word pattern of byte-level tokenizers.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PROBE = "It's 3 o'clock,  naïve\n\n \tÈre ñ 北京 \u00a0x<|endoftext|> 😀 don't\x00!  "


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in shown]
    symbols.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return symbols


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    A tokenizer file with byte-level BPE, whose merges are in the order of their ids, is run by
    tiktoken: it gives the same ids some four times faster. A probe text compares
    the two at the start. Every other file runs as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            self.fast = self._by_rank(json.load(f))
        if self.fast and self.fast.encode_ordinary(PROBE) != self._plain(PROBE):
            self.fast = None

    @staticmethod
    def _by_rank(file: dict):
        import tiktoken

        pre, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
        if (
            model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space") or file.get("normalizer") or model.get("dropout")
        ):
            return None
        added = {t["content"] for t in file.get("added_tokens", ())}
        symbols = _byte_symbols()
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))) or len(vocabulary) != 256 + len(merged):
            return None
        ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items()}
        return tiktoken.Encoding("packing", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if self.fast else self._plain(text)
        return np.array(ids, "<u4").tobytes()


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept on the tokenizers module between tasks."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_keyrill_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _pieces(tokenizer: str, capacity: int, with_ids: bool, carried: list[str] | None = None):
    carried = carried or []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, out = batch.column(0), [[] for _ in range(6)]
            for row, text in enumerate(batch.column(1)):
                tokens = encode(text.as_py() or "") + end
                n = len(tokens) // 4
                head = (n - 1) % capacity + 1
                for piece, start in enumerate([0, *range(head, n, capacity)]):
                    stop = head if piece == 0 else start + capacity
                    part = tokens[4 * start : 4 * stop]
                    values = (row, piece, start, stop - start, zlib.crc32(part), part if with_ids else None)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            rows, piece, start, length, crc, parts = out
            arrays = [
                ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            for name in carried:
                arrays.append(batch.column(name).take(pa.array(rows, pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *carried])

    return cut


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document; only documents above ``capacity`` are cut, their first piece taking the odd length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(tokenizer, capacity, with_ids), schema)


def _patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (a, b, c), a <= b <= c, of lengths filling a sequence exactly; 0 for none."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    found = []
    if present[capacity]:
        found.append(np.array([[0, 0, capacity]]))
    a = lengths[lengths <= capacity // 2]
    pairs = a[present[capacity - a]]
    found.append(np.stack([np.zeros_like(pairs), pairs, capacity - pairs], 1))
    for first in lengths[lengths <= capacity // 3]:
        b = lengths[(lengths >= first) & (lengths <= (capacity - first) // 2)]
        b = b[present[capacity - first - b]]
        found.append(np.stack([np.full_like(b, first), b, capacity - first - b], 1))
    return np.concatenate(found).astype(np.int64)


def _fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Repeat counts x >= 0 with the least squared difference between their lengths and ``counts``."""
    size = len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        total = np.zeros(size)
        for j in range(3):
            total += np.bincount(patterns[:, j], x, size)
        total[0] = 0
        return total

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    x = y = np.zeros(len(patterns))
    top, v = 1.0, np.ones(len(patterns))
    for _ in range(12):  # largest eigenvalue of the normal matrix, by power iteration
        v = back(used(v))
        top = float(np.linalg.norm(v)) or 1.0
        v = v / top
    step, t = 1 / (1.05 * top), 1.0
    for _ in range(rounds):
        new = np.maximum(0, y + step * back(counts - used(y)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, offset) placing every piece once."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    ranks = np.zeros(capacity + 1, np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, int(ranks[length]), n, sequence, offset))
        ranks[length] += n
        counts[length] -= n

    patterns = _patterns(np.flatnonzero(counts), capacity)
    if len(patterns):
        fitted = np.cumsum(_fit(patterns, counts.astype(float)))
        repeats = np.diff(np.floor(fitted + 0.5), prepend=0).astype(np.int64)
        chosen = np.flatnonzero(repeats)
        for at in chosen[np.argsort(-repeats[chosen], kind="stable")]:
            parts = [int(p) for p in patterns[at] if p]
            n = min(int(repeats[at]), *(int(counts[p]) // parts.count(p) for p in parts))
            if n > 0:
                offset = 0
                for p in parts:
                    place(p, n, sequences, offset)
                    offset += p
                sequences += n

    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, count)
    for length in range(capacity, 0, -1):
        room = length
        while counts[length]:
            while room <= capacity and not free[room]:
                room += 1
            if room > capacity:
                per = capacity // length
                n = int(counts[length])
                full, rest = divmod(n, per)
                for opened, each in ((full, per), (1, rest)):
                    if opened and each:
                        for k in range(each):
                            place(length, opened, sequences, k * length)
                        free[capacity - each * length].append((sequences, opened))
                        sequences += opened
                break
            sequence, n = free[room].pop()
            taken = min(n, int(counts[length]))
            if taken < n:
                free[room].append((sequence + taken, n - taken))
            place(length, taken, sequence, capacity - room)
            free[room - length].append((sequence, taken))
            room = max(length, room - length) if room - length >= length else room
    return np.array(runs, np.int64).reshape(-1, 5)


def _placed(runs, names: list[str]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            run = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            arrays = [batch.column(n) for n in names]
            arrays += [pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    return place


def _planned(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for window, lengths in zip(batch.column("_window").to_pylist(), batch.column("_lengths").to_pylist(), strict=True):
                table = plan({e["length"]: e["n"] for e in lengths}, capacity)
                used = int((table[:, 3] + table[:, 2]).max())
                found += [(window, used, *row) for row in table.tolist()]
            columns = zip(*found, strict=True) if found else [()] * 7
            names = ["_window", "used", "length", "first", "n", "sequence", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def pack_in_order(
    docs: DataFrame,
    tokenizer: str,
    order: str,
    window: int,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    pieces_per_slot: int = PIECES_PER_SLOT,
) -> DataFrame:
    """As ``pack``, with sequences in the order of a column of ``docs``: ``order``, a whole number from zero on.

    Each ``window`` of consecutive values is packed for itself, in a task, and its sequences are numbered after
    those of the windows before. Within a window, pieces of one length take their places in ``order`` too.
    """
    slim = docs.select(F.col("doc_id").cast("long"), "text", F.col(order).cast("long").alias("_order"))
    made = _written(slim, tokenizer, capacity, with_ids, {"_order": "long"})
    narrow = made.select("_row", *PIECE, "_order").withColumn("_window", F.floor(F.col("_order") / window).cast("long"))
    return _in_windows(made.drop("_order"), narrow, window, capacity, pieces_per_slot)


def pack_as_written(
    docs: DataFrame,
    tokenizer: str,
    window: int,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    pieces_per_slot: int = PIECES_PER_SLOT,
) -> DataFrame:
    """As ``pack_in_order``, in the order in which the rows of ``docs`` stand in the files it is read from.

    Files go by the number of the task that wrote them, then by name. A window is ``window`` consecutive tokens. Documents
    that are not read from files are written first.
    """
    try:
        docs.select(docs.metadataColumn("_metadata"))
    except AnalysisException:
        docs = materialize(docs, "packing-documents")
    at = docs.metadataColumn("_metadata")
    number = F.regexp_extract(at.getField("file_name"), r"part-(\d+)", 1)
    slim = docs.select(
        F.col("doc_id").cast("long"), "text",
        F.when(number != "", number).otherwise("0").cast("long").alias("_number"),
        at.getField("file_path").alias("_file"), at.getField("row_index").alias("_index"),
    )
    made = _written(slim, tokenizer, capacity, with_ids, {"_number": "long", "_file": "string", "_index": "long"})
    file = ["_number", "_file"]
    sums = made.groupBy(*file).agg(F.sum("length").alias("_sum"))  # a row per file
    earlier = Window.orderBy(*file).rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(sums.select(*file, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")), "packing-files")
    inside = Window.partitionBy(*file).orderBy("_index", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = made.select("_row", *PIECE, *file, "_index").join(starts, file)
    order = F.col("_before") + F.coalesce(F.sum("length").over(inside), F.lit(0))
    narrow = placed.withColumn("_order", order).select("_row", *PIECE, "_order", F.floor(F.col("_order") / window).cast("long").alias("_window"))
    return _in_windows(made.drop(*file, "_index"), narrow, window, capacity, pieces_per_slot)


def _written(slim: DataFrame, tokenizer: str, capacity: int, with_ids: bool, more: dict[str, str]) -> DataFrame:
    """The pieces of documents, written once, with columns passed on and a number of their own (``_row``)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    schema += "".join(f", {name} {kind}" for name, kind in more.items())
    cut = slim.mapInArrow(_pieces(tokenizer, capacity, with_ids, list(more)), schema)
    return materialize(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")


def _in_windows(made: DataFrame, narrow: DataFrame, window: int, capacity: int, pieces_per_slot: int) -> DataFrame:
    """``made`` with sequences by ``_window`` and ``_order`` of ``narrow``, its rows without ids, which alone are ranked."""
    narrow = materialize(narrow, "packing-order")
    histogram = materialize(narrow.groupBy("_window", "length").agg(F.count(F.lit(1)).alias("n")), "packing-lengths")
    lengths = histogram.groupBy("_window").agg(F.collect_list(F.struct("length", "n")).alias("_lengths"))
    runs = materialize(
        lengths.mapInArrow(_planned(capacity), "_window long, used long, length long, first long, n long, sequence long, offset long"),
        "packing-runs",
    )
    # One row a window: where its sequences start, and the runs of each of its lengths.
    earlier = Window.orderBy("_window").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.groupBy("_window").agg(F.max("used").alias("_used")).select(
        "_window", F.coalesce(F.sum("_used").over(earlier), F.lit(0)).alias("_start")
    )
    laid = (
        runs.join(starts, "_window")
        .select("_window", "length", F.struct("first", (F.col("sequence") + F.col("_start")).alias("sequence"), "offset").alias("_run"))
        .groupBy("_window", "length").agg(F.collect_list("_run").alias("_runs"))
    )
    # Lengths with many pieces in a window are ranked in ranges of their order, then of a hash.
    keys = ["_window", "length", "_slot"]
    many = histogram.filter(F.col("n") > pieces_per_slot).select("_window", "length", F.ceil(F.col("n") / pieces_per_slot).alias("_slots"))
    within = F.pmod(F.xxhash64("doc_id", "piece"), F.coalesce("_slots", F.lit(1)))
    light = narrow.join(many, ["_window", "length"], "left").withColumn(
        "_slot", F.when(F.col("_slots").isNull(), F.lit(0)).otherwise(F.pmod("_order", F.lit(window)) * F.col("_slots") + within).cast("long")
    ).drop("_slots")
    counted = light.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_window", "length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    table = materialize(
        counted.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).join(laid, ["_window", "length"]),
        "packing-places",
    )
    inside = Window.partitionBy(*keys).orderBy("_order", "doc_id", "piece", "ids_crc32", "start", "_row")
    placed = (
        light.withColumn("_in", F.row_number().over(inside).cast("long") - 1)
        .join(table, keys)
        .withColumn("_rank", F.col("_in") + F.col("_before"))
        .withColumn("_run", F.array_max(F.filter("_runs", lambda r: r["first"] <= F.col("_rank"))))
        .select("_row", (F.col("_run.sequence") + F.col("_rank") - F.col("_run.first")).alias("sequence_id"), F.col("_run.offset").alias("offset"))
    )
    names = [c for c in made.columns if c != "_row"]
    return made.join(placed, "_row").select(*names, "sequence_id", "offset")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    pieces_per_slot: int = PIECES_PER_SLOT,
) -> DataFrame:
    """Every piece with its sequence and offset; the pieces of a sequence leave no gap between them."""
    spark = docs.sparkSession
    made = materialize(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Each length has as many slots as its pieces fill; a bounded list, one number per length.
    slots = ",".join(str(max(1, -(-histogram.get(n, 0) // pieces_per_slot))) for n in range(1, capacity + 1))
    runs = plan(histogram, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]

    slots_of = F.element_at(F.split(F.lit(slots), ",").cast("array<bigint>"), F.col("length").cast("int"))
    slot = F.pmod(F.xxhash64("doc_id", "piece"), slots_of)
    light = made.withColumn("_slot", slot)
    counted = light.groupBy("length", "_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_slot").orderBy("doc_id", "piece", "ids_crc32", "start")
    names = list(made.columns)
    ranked = (
        light.withColumn("_in", F.row_number().over(within).cast("long") - 1)
        .join(offsets, ["length", "_slot"])
        .withColumn("_rank", F.col("_in") + F.col("_before"))
        .select(*names, "_rank")
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_placed(spark.sparkContext.broadcast(runs), names), schema)
