"""Numpy parts of suffix deduplication: anchors of long strings, and two-stage suffix sorting.

These work on the bytes of a few documents at a time, inside tasks; see ``suffix_dedup``.
"""

from __future__ import annotations

import numpy as np

GRAM = 24  # bytes under one hash, fewer than a string has
PLACES = (1 << 31) - 1  # more than the bytes of any text

_U = np.uint64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(29))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every position, by doubling."""
    h = data.astype(np.uint64) + _U(1)
    size, eight = 1, None
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5):
        h = h[: len(h) - size] * _U(factor) + h[size:]
        size *= 2
        if size == 8:
            eight = h
    n = len(data) - GRAM + 1
    return _mixed(h[:n] * _U(0xD6E8FEB86659FD93) + eight[16 : 16 + n])


def _window_minima(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings of ``length`` bytes that share their anchor's place.

    The anchor of a string is the smallest hash among its grams, so equal strings have
    equal anchors wherever they stand. ``bounds`` are the document ends in ``data``; no
    string crosses one. Gives (first start, number of starts, anchor) of each run.

    For the comparison the lower half of a hash gives way to its place, so of equal grams the
    first is taken: two equal strings that overlap have two places, and so are in two runs.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none
    hashes = _gram_hashes(data)
    ranked = (hashes & ~_U(PLACES)) | np.arange(len(hashes), dtype=np.uint64)
    smallest = _window_minima(ranked, length - GRAM + 1)
    edges = np.zeros(len(data) + 1, np.int32)
    begins = np.concatenate([[0], bounds[:-1]])
    long_enough = bounds - begins >= length
    edges[begins[long_enough]] += 1
    edges[bounds[long_enough] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(edges)[: len(smallest)] > 0)
    if not len(starts):
        return none, none, none
    value = smallest[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    places = (value[first] & _U(PLACES)).astype(np.int64)
    return starts[first], np.diff(np.append(first, len(starts))), hashes[places].view(np.int64)


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on as a big-endian number."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))


def sort_suffixes(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """``wanted`` positions in the order of the suffixes that start there, by two-stage sorting.

    Only suffixes smaller than their successors are compared, up to ``depth`` bytes; the
    others are induced from those by scanning the buckets of equal first bytes upwards:
    a suffix that stands before a placed one in the text, and is larger, comes next in
    its own bucket. ``text`` must end in a zero followed by ``depth + 8`` zeros.
    """
    n = len(text) - depth - 8
    here, there = text[:n], text[1 : n + 1]
    rises, level = here < there, here == there
    # A run of equal bytes is of the type of its last byte: that byte's position decides.
    # The zeros at the end count as small, so every chain ends at a small suffix.
    at = np.where(level, n, np.arange(n))
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = np.where(at < n, rises[np.minimum(at, n - 1)], True)

    # Beyond the last wanted position of a stretch, chains lead on to the next small suffix.
    need = np.zeros(n + 1, bool)
    need[wanted] = True
    next_small = np.where(small, np.arange(n), n)
    next_small = np.minimum.accumulate(next_small[::-1])[::-1]
    tails = wanted[~need[wanted + 1] & ~small[wanted]]
    lengths = next_small[tails] - tails
    extra = np.repeat(tails - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum()) + 1
    need[extra] = True

    need[n] = False
    chosen = np.flatnonzero(need[:n])
    direct = small[chosen]
    sorted_small = _compare(text, chosen[direct], depth)
    induced = np.zeros(n + 1, bool)
    induced[chosen[~direct]] = True

    first_bytes = text[sorted_small]
    cuts = np.searchsorted(first_bytes, np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    order: list[np.ndarray] = []
    for byte in range(256):
        level_now = np.concatenate(pending[byte]) if pending[byte] else np.zeros(0, np.int64)
        bucket = []
        while len(level_now):
            bucket.append(level_now)
            before = level_now - 1
            level_now = before[induced[before] & (text[before] == byte)]
        bucket.append(sorted_small[cuts[byte] : cuts[byte + 1]])
        whole = np.concatenate(bucket)
        if not len(whole):
            continue
        order.append(whole)
        before = whole - 1
        before = before[induced[before] & (text[before] > byte)]
        if len(before):
            bytes_before = text[before]
            by_byte = np.argsort(bytes_before, kind="stable")
            before, bytes_before = before[by_byte], bytes_before[by_byte]
            for part in np.split(before, np.flatnonzero(np.diff(bytes_before)) + 1):
                pending[int(text[part[0]])].append(part)
    placed = np.concatenate(order) if order else np.zeros(0, np.int64)
    keep = np.zeros(n + 1, bool)
    keep[wanted] = True
    return placed[keep[placed]]


def _compare(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` bytes there; ties are refined word by word."""
    words = _words(text)
    order = np.argsort(words[at].astype(np.uint64), kind="stable")
    at = at[order]
    key = words[at]
    tied = np.zeros(len(at), bool)
    same = key[1:] == key[:-1]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(at) else np.zeros(0, np.int64)
    tied[1:] |= same
    tied[:-1] |= same
    slots = np.flatnonzero(tied)
    for offset in range(8, depth, 8):
        if not len(slots):
            break
        members, groups = at[slots], group[slots]
        word = words[members + offset].astype(np.uint64)
        order = np.lexsort((word, groups))
        members, word = members[order], word[order]
        at[slots] = members
        same = (word[1:] == word[:-1]) & (groups[1:] == groups[:-1])
        groups = np.concatenate([[0], np.cumsum(~same)])
        group[slots] = groups
        tied = np.zeros(len(slots), bool)
        tied[1:] |= same
        tied[:-1] |= same
        slots = slots[tied]
    return at


def common_prefix(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix in ``order`` shares with the one before it."""
    words = _words(text)
    shared = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for offset in range(0, most, 8):
        if not len(alive):
            break
        a, b = words[order[alive] + offset].astype(np.uint64), words[order[alive - 1] + offset].astype(np.uint64)
        differ = a ^ b
        equal = differ == 0
        shared[alive[equal]] += 8
        rest = differ[~equal]
        lead = np.zeros(len(rest), np.int64)
        for k in range(1, 8):
            lead += (rest >> _U(64 - 8 * k)) == 0
        shared[alive[~equal]] += lead
        alive = alive[equal]
    return np.minimum(shared, most)
