"""Suffix arrays and common prefixes against plain sorting, also with many equal and overlapping strings."""

import numpy as np
import pytest

from blotter.llm import suffix_array as sa_module
from blotter.llm.suffix_array import StringSet, common_prefixes, suffix_array


def _strings(seed):
    rng = np.random.default_rng(seed)
    core = bytes(rng.integers(97, 99, 300).astype(np.uint8))
    out = [core[a : a + int(n)] for a, n in zip(rng.integers(0, 200, 30), rng.integers(1, 100, 30))]
    out += [b"a" * int(n) for n in rng.integers(0, 60, 5)] + [b"ab" * 30, b"", b"x", core]
    return out


@pytest.mark.parametrize("depth", [8, 14, 20, 37, 100])
@pytest.mark.parametrize("seed", [0, 1])
def test_order_and_prefixes(depth, seed, monkeypatch):
    strings = _strings(seed)
    text = StringSet(strings)
    got = suffix_array(text, depth)
    at = {}
    for k, s in enumerate(strings):
        for i in range(len(s) - depth + 1):
            at[int(text.starts[k]) + i] = s[i : i + depth]
    assert got.tolist() == sorted(at, key=lambda p: (at[p], p))
    shared = common_prefixes(text, got, depth)
    for k in range(1, len(got)):
        a, b = at[int(got[k - 1])], at[int(got[k])]
        same = next((n for n in range(depth) if a[n] != b[n]), depth)
        assert shared[k] == same
    pairs = sa_module._sorted_pairs
    monkeypatch.setattr(sa_module, "_sorted_pairs", lambda a, b, n: pairs(a, b, 1 << 30))
    assert suffix_array(text, depth).tolist() == got.tolist()


def test_no_string_is_long_enough():
    assert len(suffix_array(StringSet([b"abc", b""]), 100)) == 0
