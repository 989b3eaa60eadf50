"""Suffix arrays of many short byte strings, in numpy.

Strings lie one behind another, each followed by ``PAD`` zero symbols, so a
suffix never reads into the next string.  Symbols are bytes + 1 in 16 bits.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

PACKED = 7  # symbols in a 64-bit number
PAD = 8  # symbols after each string; ranks look at most this far past an end at first


class StringSet:
    """The concatenated strings: symbols, and for every position its string and its end."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.zeros(len(strings), dtype=np.int64)
        np.cumsum(sizes[:-1] + PAD, out=self.starts[1:])
        self.stops = self.starts + sizes
        total = int(self.stops[-1]) + PAD
        gap = bytes(PAD)
        flat = np.frombuffer(gap.join(strings) + gap, dtype=np.uint8)
        inside = np.zeros(total + 1, dtype=np.int32)
        np.add.at(inside, self.starts, 1)
        np.add.at(inside, self.stops, -1)
        self.inside = np.cumsum(inside[:-1]).astype(bool)
        self.symbols = np.where(self.inside, flat[:total].astype(np.uint16) + 1, 0).astype(np.uint16)
        self.owner = np.repeat(np.arange(len(strings), dtype=np.int32), sizes + PAD)

    @cached_property
    def packed(self) -> np.ndarray:
        """``PACKED`` symbols from every position on, in one number that sorts as they do."""
        x = np.concatenate([self.symbols, np.zeros(PACKED, dtype=np.uint16)]).astype(np.uint64)
        n = len(self.symbols)
        out = np.zeros(n, dtype=np.uint64)
        for k in range(PACKED):
            out = out * np.uint64(257) + x[k : k + n]
        return out


def suffix_array(strings: StringSet, depth: int) -> np.ndarray:
    """Positions with ``depth`` symbols up to the end of their string, sorted by those symbols.

    Larsson-Sadakane refinement: suffixes sorted by h symbols fall into groups
    of equals; groups of more than one are sorted by the group of the suffix h
    symbols further on, which doubles h (the last step goes to ``depth`` alone).
    Settled suffixes are not touched again.  A suffix shorter than the symbols
    it is to be sorted by is left out from there on: no longer one reads it.
    """
    n = len(strings.symbols)
    room = np.where(strings.inside, strings.stops[strings.owner] - np.arange(n), 0)
    h = PACKED
    at = np.flatnonzero(room >= h)
    key = strings.packed[at]
    order = np.argsort(key)
    sa, key = at[order], key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])[: len(sa)]
    group = np.zeros(n + 1, dtype=np.uint32)
    group[sa] = np.maximum.accumulate(np.where(head, np.arange(1, len(sa) + 1), 0))
    while h < depth:
        to = min(2 * h, depth)
        sa = sa[room[sa] >= to]
        old = group[sa]
        same = old[1:] == old[:-1]
        open_ = np.flatnonzero(np.append(same, False) | np.concatenate([[False], same])[: len(sa)])
        pos, old = sa[open_], old[open_]
        order, key = _sorted_pairs(old.astype(np.uint64), group[pos + (to - h)], n)
        pos = pos[order]
        sa[open_] = pos
        place = np.arange(len(pos))
        first = np.concatenate([[True], key[1:] != key[:-1]])[: len(pos)]
        start = np.concatenate([[True], old[1:] != old[:-1]])[: len(pos)]
        offset = np.maximum.accumulate(np.where(first, place, 0)) - np.maximum.accumulate(np.where(start, place, 0))
        group[pos] = old + offset.astype(np.uint32)
        h = to
    # equals in the order of their positions, which common_prefixes gains from
    return (np.sort((group[sa].astype(np.uint64) << np.uint64(32)) | sa.astype(np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _sorted_pairs(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pairs (a, b) of numbers up to ``most``, and the sorted pairs as one number each."""
    bits = np.uint64(21)
    if most >= 1 << 21:
        key = (a << np.uint64(32)) | b
        order = np.argsort(key)
        return order, key[order]
    # pair and place fit in 64 bits, and sorting numbers is faster than sorting their places
    key = (((a << bits) | b) << bits) | np.arange(len(a), dtype=np.uint64)
    key.sort()
    return (key & np.uint64((1 << 21) - 1)).astype(np.int64), key >> bits


def common_prefixes(strings: StringSet, sa: np.ndarray, cap: int) -> np.ndarray:
    """Kasai: for each entry of ``sa``, the symbols shared with the entry before (at most ``cap``).

    Strings are walked side by side from their first position; when a
    position shares l symbols with its predecessor, the next one shares at
    least l - 1 with its own, if the one after the predecessor is an entry that
    lies before it (entries equal in ``cap`` symbols are in no order of what
    follows).  So few symbols are compared twice.  Every entry has ``cap``
    symbols left in its string.
    """
    n = len(strings.symbols)
    symbols, packed = strings.symbols, strings.packed
    before = np.full(n + 1, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    rank = np.full(n + 1, n, dtype=np.int64)  # n: no entry
    rank[sa] = np.arange(len(sa))
    plcp = np.zeros(n, dtype=np.int16)
    order = np.argsort(strings.starts - strings.stops, kind="stable")  # longest first
    base, size = strings.starts[order], (strings.stops - strings.starts)[order] - cap + 1
    shared = np.zeros(len(base), dtype=np.int64)
    last = np.full(len(base), -1, dtype=np.int64)
    lanes = len(base)
    for k in range(int(size[0]) if lanes else 0):
        while lanes and size[lanes - 1] <= k:
            lanes -= 1
        i = base[:lanes] + k
        j = before[i]
        follows = (last[:lanes] >= 0) & (rank[last[:lanes] + 1] < rank[i])
        length = np.where(follows, np.maximum(shared[:lanes] - 1, 0), 0)
        active = np.flatnonzero((j >= 0) & (length + PACKED <= cap))
        while len(active):  # several symbols at a time, then one by one
            at = length[active]
            active = active[packed[i[active] + at] == packed[j[active] + at]]
            length[active] += PACKED
            active = active[length[active] + PACKED <= cap]
        active = np.flatnonzero((j >= 0) & (length < cap))
        while len(active):
            at = length[active]
            active = active[symbols[i[active] + at] == symbols[j[active] + at]]
            length[active] += 1
            active = active[length[active] < cap]
        shared[:lanes], last[:lanes] = length, j
        plcp[i] = length
    return plcp[sa].astype(np.int64)


def search(strings: StringSet, sorted_at: np.ndarray, other: StringSet, at: np.ndarray, depth: int) -> np.ndarray:
    """For positions ``at`` of ``other``, the index in ``sorted_at`` with the same
    ``depth`` symbols, or -1; by binary search over the sorted suffixes."""
    low = np.zeros(len(at), dtype=np.int64)
    high = np.full(len(at), len(sorted_at), dtype=np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_]) // 2
        less = _order(strings, sorted_at[mid], other, at[open_], depth) < 0
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    found = np.full(len(at), -1, dtype=np.int64)
    there = np.flatnonzero(low < len(sorted_at))
    same = _order(strings, sorted_at[low[there]], other, at[there], depth) == 0
    found[there[same]] = low[there[same]]
    return found


def _order(a: StringSet, i: np.ndarray, b: StringSet, j: np.ndarray, depth: int) -> np.ndarray:
    """-1, 0 or 1: order of the ``depth`` symbols at i and at j (both inside a string)."""
    out = np.zeros(len(i), dtype=np.int8)
    open_ = np.arange(len(i))
    for k in range(depth):
        if not len(open_):
            break
        x = a.symbols[i[open_] + k].astype(np.int32)
        y = b.symbols[j[open_] + k].astype(np.int32)
        out[open_] = np.sign(x - y)
        open_ = open_[x == y]
    return out
