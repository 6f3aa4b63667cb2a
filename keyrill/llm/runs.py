"""Runs of repeated words, by enumerating maximal pairs in the tree of LCP-intervals.

A run is a stretch of words with smallest period q whose length is at least ``SHORTEST`` and ``TIMES`` * q, and that no
neighbouring word extends with period q. The words i and j of a maximal pair (i, j, l) begin equal stretches
of l words with unequal words before and after them; with j - i = q it lies in a stretch of q + l words that has
period q and cannot be extended. So the maximal pairs with l >= (TIMES - 1) * q and l + q >= SHORTEST are exactly the runs,
and their multiples, which share start and end with them: the least q of each stretch is kept.

The pairs come bottom-up from the tree of LCP-intervals over the sorted suffixes. Every node holds its
positions by the word to their left, in ascending lists; where children meet, each position of the smaller one looks
in the larger one for positions within l / (TIMES - 1), in the lists of other left words only. As overlapping occurrences that near are
steps of one period, all but the first of them have the same word to their left: the first two positions
in the window name the lists to read, and each pair found is a run or a multiple of one.

Stretches of a pair have at least ``least_shared`` words, so only positions whose next words (so many) come again in the
document can be in one. They are found over many documents at once by hashes of windows of words (equal windows have
equal hashes); documents without any have no run. Sorting and tree are exact, over the words of the others.

Documents are independent, so nothing is shuffled. Defined cases: a null or empty text, or one of white space only, has no words, no run and
an empty collapsed text; repeated rows and null doc_ids are documents of their own; very long texts are
handled alone and whole; an empty table gives no rows. ``find`` keeps the columns it is told to keep, ``collapse`` all of
them; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST = 24
TIMES = 3
WORDS_AT_ONCE = 1 << 19

Run = tuple[int, int, int]  # start, length, period, in words

RUNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def least_shared(shortest: int = SHORTEST, times: int = TIMES) -> int:
    """Words that both stretches of a pair have at least: l >= (times - 1) q and l >= shortest - q."""
    return max(times - 1, -(-shortest * (times - 1) // times))


def recurring(hashes: np.ndarray, documents: np.ndarray, width: int) -> np.ndarray:
    """Positions whose window of ``width`` words is likely to come again in its document; none that does is missing.

    ``hashes`` are of the words of all documents in turn, ``documents`` the number of the document of each.
    """
    size = len(hashes) - width + 1
    if size < 2:
        return np.zeros(0, np.int64)
    odd = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
    whole, done, step, have = None, 0, hashes.view(np.uint64).copy(), 1
    while True:  # windows of 1, 2, 4, ... words, put together to one of ``width``
        if width & have:
            part = step[done : done + size]
            whole = part.copy() if whole is None else (whole * odd[0] ^ (whole >> np.uint64(29))) + part
            done += have
        if 2 * have > width:
            break
        mixed = step[:-have] * odd[1]
        mixed ^= mixed >> np.uint64(31)
        step = mixed * odd[0] + step[have:]
        have *= 2
    inside = documents[:size] == documents[width - 1 :]
    at = np.flatnonzero(inside)
    keys = whole[at] ^ documents[at].astype(np.uint64) * odd[1]
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return np.zeros(0, np.int64)
    found = np.minimum(np.searchsorted(again, keys), len(again) - 1)
    return at[again[found] == keys]


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence of numbers in order, by prefix doubling; an ending comes before what goes on."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank = np.empty(n, np.int64)
    heads = np.concatenate([[True], np.diff(codes[order]) != 0])
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    # Only groups of equal prefixes are sorted on, each within its own places.
    bounds = np.flatnonzero(np.append(heads, True))
    size = np.repeat(np.diff(bounds), np.diff(bounds))
    open_at = np.flatnonzero(size > 1)
    width = 1
    while len(open_at):
        held = order[open_at]
        after = held + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[held]
        turn = np.lexsort((second, first))
        held, first, second = held[turn], first[turn], second[turn]
        order[open_at] = held
        new = np.concatenate([[True], (np.diff(first) != 0) | (np.diff(second) != 0)])
        head_at = np.maximum.accumulate(np.where(new, np.arange(len(held)), 0))
        rank[held] = open_at[head_at]
        marks = np.flatnonzero(np.append(new, True))
        size = np.repeat(np.diff(marks), np.diff(marks))
        open_at = open_at[size > 1]
        width *= 2
    return order


def common_prefixes(codes: list[int], order: list[int]) -> list[int]:
    """Per place in the order, the words its suffix shares with the one before it (0 for the first)."""
    n = len(codes)
    before = [-1] * n
    for earlier, later in zip(order, order[1:]):
        before[later] = earlier
    shared = [0] * n
    length = 0
    for i in range(n):
        j = before[i]
        if j < 0:
            length = 0
            continue
        most = n - max(i, j)
        while length < most and codes[i + length] == codes[j + length]:
            length += 1
        shared[i] = length
        if length:
            length -= 1
    return [shared[i] for i in order]


class Node:
    """Positions of an LCP-interval: all, and by the word to their left (-1 before the first), ascending."""

    __slots__ = ("all", "classes")

    def __init__(self, position: int, left: int):
        self.all = [position]
        self.classes = {left: [position]}

    def add(self, position: int, left: int) -> None:
        insort(self.all, position)
        held = self.classes.get(left)
        if held is None:
            self.classes[left] = [position]
        else:
            insort(held, position)


def _meet(one: Node, other: Node, shared: int, left: list[int], shortest: int, times: int, found: dict) -> Node:
    """The node of two children whose common prefix has ``shared`` words; notes the pairs between them."""
    small, large = (one, other) if len(one.all) <= len(other.all) else (other, one)
    far = shared // (times - 1)
    for x in small.all:
        places = large.all
        low = bisect_left(places, x - far)
        high = bisect_right(places, x + far, low)
        if low == high:
            continue
        for word in {left[places[low]], left[places[min(low + 1, high - 1)]]}:
            if word == left[x]:
                continue
            near = large.classes[word]
            for y in near[bisect_left(near, x - far) : bisect_right(near, x + far)]:
                start, period = (x, y - x) if x < y else (y, x - y)
                length = shared + period
                if length >= shortest and found.get((start, length), period) >= period:
                    found[start, length] = period
    for x in small.all:
        large.add(x, left[x])
    return large


def maximal_runs(codes: Sequence[int] | np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> list[Run]:
    """All runs of a sequence, by start, then period."""
    if times < 3:
        raise ValueError("a run must hold its period three times at least")
    codes = np.asarray(codes, np.int64)
    if len(codes) < shortest:
        return []
    least = least_shared(shortest, times)
    order = suffix_order(codes).tolist()
    words = codes.tolist()
    shared = common_prefixes(words, order)
    left = [-1, *words]  # left[i] is the word before position i
    found: dict[tuple[int, int], int] = {}
    # Open intervals, by rising depth: [depth, node]. Below ``least`` none is needed.
    stack: list[list] = []
    leaf = Node(order[0], left[order[0]])
    for place in range(1, len(order) + 1):
        depth = shared[place] if place < len(order) else 0
        node = leaf
        while stack and stack[-1][0] > depth:
            top, held = stack.pop()
            node = _meet(held, node, top, left, shortest, times, found)
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][1] = _meet(stack[-1][1], node, depth, left, shortest, times, found)
            else:
                stack.append([depth, node])
        if place < len(order):
            leaf = Node(order[place], left[order[place]])
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def longest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; of equal ones the first, then the one with the least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def runs_of(texts: Sequence[str | None], shortest: int = SHORTEST, times: int = TIMES) -> Iterator[tuple[list[bytes], list[Run]]]:
    """The words of each text and its runs."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = (text or "").encode().split()
        if held and size + len(words) > WORDS_AT_ONCE:
            yield from _together(held, size, shortest, times)
            held, size = [], 0
        held.append(words)
        size += len(words)
    yield from _together(held, size, shortest, times)


def _together(held: list[list[bytes]], size: int, shortest: int, times: int) -> Iterator[tuple[list[bytes], list[Run]]]:
    hashes = np.fromiter(map(hash, chain.from_iterable(held)), np.int64, size)
    documents = np.repeat(np.arange(len(held)), [len(words) for words in held])
    some = set(documents[recurring(hashes, documents, least_shared(shortest, times))].tolist())
    for number, words in enumerate(held):
        if number in some:
            known: dict[bytes, int] = {}
            codes = [known.setdefault(w, len(known)) for w in words]
            yield words, maximal_runs(codes, shortest, times)
        else:
            yield words, []


def _found(keep: list[str], shortest: int, times: int):
    kinds = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, runs = [], []
            for row, (_, found) in enumerate(runs_of(batch.column(0).to_pylist(), shortest, times)):
                rows += [row] * len(found)
                runs += found
            taken = pa.array(rows, pa.int64())
            columns = [batch.column(i + 1).take(taken) for i in range(len(keep))]
            values = [pa.array([r[i] for r in runs], kind) for i, (_, kind) in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*columns, *values], names=[*keep, *(n for n, _ in kinds)])

    return run


def find(docs: DataFrame, keep: Sequence[str] = ("doc_id",), shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """A row per run: the columns to keep, then start, length and period in words."""
    schema = docs.select(*keep).schema.add("start", "long").add("length", "long").add("period", "long")
    return docs.select("text", *keep).mapInArrow(_found(list(keep), shortest, times), schema)


def _collapsed(at: int, shortest: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for row, (words, runs) in enumerate(runs_of(texts, shortest, times)):
                if runs:
                    keep = kept_words(len(words), runs)
                    texts[row] = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k]).decode()
            columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def collapse(docs: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """``docs`` with each run cut to its first period; texts without a run stay as they are."""
    return docs.mapInArrow(_collapsed(docs.columns.index("text"), shortest, times), docs.schema)


def _digest(shortest: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for words, runs in runs_of(batch.column(1).to_pylist(), shortest, times):
                best = longest(runs)
                top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                if runs:
                    words = [w for w, k in zip(words, kept_words(len(words), runs).tolist(), strict=True) if k]
                rows.append((len(runs), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return run


def run_digest(docs: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """A row per document: the number of its runs, the strongest one, and digests of all runs and of the collapsed text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digest(shortest, times), "doc_id long, " + RUNS)


def planted(doc_id: Column, text: Column) -> Column:
    """``text``, for one document in ten with a periodic tail: word i from a on becomes word a + (i - a) % p."""
    h = F.crc32(doc_id.cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.nullif(F.size(words).cast("long"), F.lit(0).cast("long"))
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")

    def tail(state: Column) -> Column:
        first = F.slice(state["words"], F.lit(1), state["a"].cast("int"))
        places = F.transform(
            F.sequence(F.lit(0).cast("long"), F.size(state["words"]) - 1 - state["a"]),
            lambda k: F.get(state["words"], (state["a"] + k % state["p"]).cast("int")),
        )
        return F.array_join(F.concat(first, places), " ")

    # One element, so that words, a and p are worked out once a document.
    state = F.array(F.struct(words.alias("words"), a.alias("a"), p.alias("p")))
    changed = F.get(F.transform(F.filter(state, lambda s: s["a"].isNotNull()), tail), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(changed, F.lit(""))).otherwise(text)
