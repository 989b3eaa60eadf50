"""Recompression: a run-length grammar whose levels answer longest common extensions.

Level 0 is the sequence.  Block compression replaces every maximal block of
one symbol by a symbol of its own; pair compression then splits the symbols
into left and right ones and replaces every left-right pair.  Equal stretches
are parsed alike but for a constant number of symbols at either end, whatever
surrounds them, and a level is a constant factor shorter than the one below
in expectation.  Compression ends when no symbol occurs twice: no two
positions have anything in common above that.

A position is a boundary between symbols.  Each boundary of a level knows its
place one level down and, where a symbol of the next level starts there too,
one level up.  An extension of two positions climbs while the symbols of the
next level agree, moves over equal symbols (over a whole block at once where
equal symbols repeat) and descends where they differ, so a query takes a
number of moves in the order of the number of levels.  Queries are answered
many at a time; all levels lie in one flat array.
"""

from __future__ import annotations

import numpy as np

from blotter.llm.kernels import mix


def _side(symbols: np.ndarray, salt: int) -> np.ndarray:
    """One pseudo-random bit per symbol: right (true) or left."""
    return (mix(symbols.astype(np.uint64) + np.uint64((salt + 1) << 40)) & np.uint64(1)).astype(bool)


class Grammar:
    """The levels over ``ids``, whole numbers from 0 on."""

    def __init__(self, ids: np.ndarray) -> None:
        syms, starts, ahead, behind = [np.asarray(ids, dtype=np.int64)], [], [], []
        salt = 0
        while True:
            sym = syms[-1]
            m = len(sym)
            blocks, before, after = _blocks(sym)
            ahead.append(before)
            behind.append(after)
            if m < 2 or np.bincount(sym).max() < 2:
                break
            if len(blocks) < m:
                count = np.diff(blocks, append=m)
                key = sym[blocks] * (count.max() + 1) + count
                starts.append(blocks)
            else:
                pairs = np.zeros(0, dtype=np.int64)
                while not len(pairs):
                    right = _side(sym, salt)
                    pairs = np.flatnonzero(~right[:-1] & right[1:])
                    salt += 1
                first = np.ones(m, dtype=bool)
                first[pairs + 1] = False
                size = sym.max() + 1
                key = sym.copy()
                key[pairs] = (sym[pairs] + 1) * size + sym[pairs + 1]
                key = key[first]
                starts.append(np.flatnonzero(first))
            syms.append(np.unique(key, return_inverse=True)[1].astype(np.int64))
        self._lay_out(syms, starts, ahead, behind)

    def _lay_out(self, syms, starts, ahead, behind) -> None:
        # one entry per boundary, and an entry in front that is no symbol
        base = np.cumsum([1] + [len(s) + 1 for s in syms])
        total = int(base[-1])
        self.sym = np.full(total, -1, dtype=np.int32)
        self.ahead = np.ones(total, dtype=np.int32)
        self.behind = np.ones(total, dtype=np.int32)
        self.up = np.full(total, -1, dtype=np.int32)
        self.down = np.full(total, -1, dtype=np.int32)
        for k, s in enumerate(syms):
            at, end = base[k], base[k] + len(s)
            self.sym[at:end] = s
            self.ahead[at:end] = ahead[k]
            self.behind[at + 1 : end + 1] = behind[k]
            if k:
                below = base[k - 1] + np.append(starts[k - 1], len(syms[k - 1]))
                self.down[at : end + 1] = below
                self.up[below] = np.arange(at, end + 1)
        self.levels = len(syms)

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from positions i and j on agree (before them with ``back``); i < j."""
        x, y = np.asarray(i) + 1, np.asarray(j) + 1
        out = np.zeros(len(x), dtype=np.int64)
        x, y = x.astype(np.int32), y.astype(np.int32)
        live, begun = np.arange(len(x)), x.copy()
        shift, span, sign = (1, self.behind, -1) if back else (0, self.ahead, 1)
        while len(live):
            ux, uy = self.up[x], self.up[y]
            climbs = (ux >= 0) & (uy >= 0) & (self.sym[ux - shift] == self.sym[uy - shift]) & (self.sym[ux - shift] >= 0)
            moves = ~climbs & (self.sym[x - shift] == self.sym[y - shift])
            falls = ~climbs & ~moves
            step = np.where(moves, np.minimum(span[x], span[y]), 0) * sign
            dx, dy = self.down[x], self.down[y]
            done = falls & (dx < 0)
            if done.any():
                out[live[done]] = np.abs(x[done] - begun[live[done]])
            x = np.where(climbs, ux, np.where(falls, dx, x + step))
            y = np.where(climbs, uy, np.where(falls, dy, y + step))
            keep = ~done
            live, x, y = live[keep], x[keep], y[keep]
        return out


def _blocks(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the blocks, and per symbol how much of its block lies ahead and behind (itself included)."""
    m = len(sym)
    if not m:
        return np.zeros(0, dtype=np.int64), sym, sym
    first = np.ones(m, dtype=bool)
    first[1:] = sym[1:] != sym[:-1]
    starts = np.flatnonzero(first)
    of = np.cumsum(first) - 1
    ends = np.append(starts[1:], m)
    at = np.arange(m)
    return starts, ends[of] - at, at - starts[of] + 1
