"""Periodic runs against a comparison of all positions, and the grammar's answers one by one."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import periodic_runs
from blotter.llm.queries import op13_periodic_runs
from blotter.llm.recompression import Grammar
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _common(ids, i, j, step):
    n = 0
    while 0 <= i < len(ids) and 0 <= j < len(ids) and ids[i] == ids[j]:
        i, j, n = i + step, j + step, n + 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=2, max_size=80), st.integers(0, 9))
def test_grammar_extensions(ids, repeat):
    ids = np.array(ids * (1 + repeat % 3) + [9] + ids[::2] + [0] * repeat)
    g = Grammar(np.unique(ids, return_inverse=True)[1])
    i, j = np.triu_indices(len(ids), 1)
    assert list(g.extend(i, j)) == [_common(ids, a, b, 1) for a, b in zip(i, j)]
    assert list(g.extend(i, j, back=True)) == [_common(ids, a - 1, b - 1, -1) for a, b in zip(i, j)]


def test_long_block_takes_few_levels():
    g = Grammar(np.zeros(1 << 18, dtype=np.int64))
    assert g.levels == 2
    assert list(g.extend(np.array([0, 5]), np.array([1, 1000]))) == [(1 << 18) - 1, (1 << 18) - 1000]
    assert list(g.extend(np.array([7]), np.array([9]), back=True)) == [7]


def _runs(w):
    """(start, length, period), by comparing every position with the one a period later."""
    out = {}
    n = len(w)
    for q in range(1, n // 3 + 1):
        s = 0
        while s + q < n:
            if w[s] != w[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e + q - s >= max(24, 3 * q):
                out.setdefault((s, e + q), q)
            s = e + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def _collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def _texts():
    rng = np.random.default_rng(5)
    vocab = ["a", "b", "the", "é", "x1"]
    out = [None, "", " \n\t ", "a " * 23, "a " * 24, "a b " * 12, "a b c " * 7, "ab " * 5000]
    for k in range(60):
        piece = list(rng.choice(vocab, rng.integers(1, 40)))
        head = list(rng.choice(vocab[: 1 + k % 5], rng.integers(0, 60)))
        body = (piece * 12)[: int(rng.integers(20, 200))]
        inner = (body + ["z"]) * int(rng.integers(1, 6))
        out.append("\n ".join(head + inner + head[::-1]))
    out.append(" ".join(f"w{k % 997}" for k in range(9000)) + " tail")
    return out


SCHEMA = "doc_id long, text string, id long, runs string, n_words int, collapsed int, `a.b` int"


def test_runs_of_untidy_texts(spark):
    rows = [(k // 2 if k % 5 else None, t, 1, "r", 2, 3, 4) for k, t in enumerate(_texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    shown = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()
    )
    want = []
    for k, t, *_ in rows:
        w = WORD.findall(t or "")
        # the plain search of the long texts would take too long
        runs = _runs(w) if len(w) < 3000 else [(0, 5000, 1)] if w[0] == "ab" else [(0, 9000, 997)]
        want.append((k is None, k or 0, len(w), runs, _collapsed(w, runs)))
    assert shown == sorted(want)


def test_slices_do_not_change_runs(monkeypatch):
    texts = [(t or "").encode() for t in _texts()]
    whole = periodic_runs._slice(texts)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 7)
    assert periodic_runs._slice(texts).equals(whole)
    parts = [periodic_runs._slice([t]).to_pylist()[0] for t in texts]
    assert parts == whole.to_pylist()


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def _contract(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs(w)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, _sha(lines), _sha(_collapsed(w, runs)))


def _sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("longest", [1500])
def test_query_row_by_row(spark, longest):
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    assert sum(r[1] for r in got.values()) > 0
    for d in docs:
        if len(WORD.findall(d.text or "")) <= longest:  # the plain search is quadratic
            assert got[d.doc_id] == _contract(d.doc_id, d.text)
