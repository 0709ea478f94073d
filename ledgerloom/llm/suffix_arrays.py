"""Suffix arrays of byte strings in numpy: refinement by doubling, common prefixes, repeated windows."""

from __future__ import annotations

import numpy as np

# Symbols of the first sort key; nine bits each hold a byte or the separator.
FIRST = 6


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[:len(values) - by] = values[by:]
    return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``symbols`` (0 to 511) in order; a suffix comes after its prefixes.

    Larsson-Sadakane: positions are ranked by a prefix; the rank of the position one prefix further
    on doubles it. Only groups that are not single yet are sorted again.
    """
    n = len(symbols)
    one = symbols.astype(np.int64)
    two = one << 9 | _shifted(one, 1)
    four = two << 18 | _shifted(two, 2)
    key = four << 18 | _shifted(two, 4)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0  # past the end
    starts = np.ones(n, bool)
    starts[1:] = key[order[1:]] != key[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0)) + 1
    reach = FIRST
    while True:
        # A group is not single if it goes on after its start.
        goes_on = np.append(~starts[1:], False)
        slots = np.flatnonzero(~starts | goes_on)
        if not len(slots):
            return order
        at = order[slots]
        pair = rank[at] * (n + 2) + rank[np.minimum(at + reach, n)]
        again = np.argsort(pair, kind="stable")
        order[slots] = at[again]
        sorted_pair = pair[again]
        fresh = np.ones(len(slots), bool)
        fresh[1:] = sorted_pair[1:] != sorted_pair[:-1]
        starts[slots] = fresh
        rank[order[slots]] = np.maximum.accumulate(np.where(fresh, slots, 0)) + 1
        reach *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray, bounds: np.ndarray,
                    cap: int) -> np.ndarray:
    """Common prefix lengths, up to ``cap``, of neighbours in ``order``; 0 for the first.

    Kasai: the common prefix of the suffix at i + 1 with its predecessor is at least that of i less
    one. The strings, which start at ``bounds[:-1]``, are walked in step with each other.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.append(symbols.astype(np.int64), np.full(cap + 1, -1))
    lengths = np.zeros(n, np.int64)
    starts, sizes = bounds[:-1], np.diff(bounds)
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    length = np.zeros(len(starts), np.int64)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        there = int(np.searchsorted(-sizes, -step, side="left"))
        at = starts[:there] + step
        other = before[at]
        now = np.where(other >= 0, np.maximum(length[:there] - 1, 0), 0)
        grow = np.flatnonzero((other >= 0) & (now < cap))
        while len(grow):
            a, b = at[grow] + now[grow], other[grow] + now[grow]
            grow = grow[(padded[a] == padded[b]) & (padded[a] >= 0)]
            now[grow] += 1
            grow = grow[now[grow] < cap]
        length = now
        lengths[at] = now
    return lengths[order]


def window_classes(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal ``length``-byte windows of all strings.

    Returns, per window, the string, the start in it, and a class number that equal windows share;
    windows come in lexicographic order.
    """
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[bounds[1:] - 1] = 0
    order = suffix_array(symbols)
    prefix = common_prefixes(symbols, order, bounds, length)
    classes = np.cumsum(prefix < length)
    owner = np.searchsorted(bounds, order, side="right") - 1
    start = order - bounds[owner]
    whole = start + length < sizes[owner]
    return owner[whole], start[whole], classes[whole]
