"""Near copies of vectors against a comparison of all pairs."""

import numpy as np
import pytest

from blotter.llm import neighbours
from blotter.llm.queries import op12_embedding_neighbours
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<float>, label int, node long, g long, u long, v long, sim double, `a.b` int"


def _all_pairs(rows, threshold=neighbours.THRESHOLD):
    """(n_links, component id, kept) of each (id, vector, label)."""

    def usable(x, label):
        return x and label is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)

    unit = []
    for _, x, label in rows:
        if usable(x, label):
            a = np.array(x, dtype=np.float32).astype(np.float64)
            a /= np.abs(a).max()
            unit.append(a / np.linalg.norm(a))
        else:
            unit.append(None)
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is None or unit[b] is None or rows[a][2] != rows[b][2] or len(unit[a]) != len(unit[b]):
                continue
            if unit[a] @ unit[b] >= threshold:
                links[a].append(b)
                links[b].append(a)
    out, seen = [None] * len(rows), set()
    for a in range(len(rows)):
        if a in seen:
            continue
        group, stack = {a}, [a]
        while stack:
            for b in links[stack.pop()]:
                if b not in group:
                    group.add(b)
                    stack.append(b)
        seen |= group
        ids = [rows[b][0] for b in group if rows[b][0] is not None]
        name = min(ids) if ids else None
        for b in group:
            out[b] = (rows[b][0], len(links[b]), name, rows[b][0] == name)
    return out


def _order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def _vectors():
    """Loose, tight and stretched groups, copies, and vectors that link with nothing."""
    rng = np.random.default_rng(3)
    d, rows = 8, []

    def add(x, label, key=True):
        rows.append((len(rows) if key else None, None if x is None else [float(c) for c in x], label))

    for _ in range(150):
        add(rng.standard_normal(d), int(rng.integers(0, 3)))
    for spread, n in ((0.05, 60), (0.16, 60), (0.01, 5)):  # angles well below, around and far below the threshold
        centre = rng.standard_normal(d)
        for _ in range(n):
            add(centre / np.linalg.norm(centre) + spread * rng.standard_normal(d), 1)
    for k in range(40):  # a chain: neighbours link, ends do not
        add([np.cos(k / 12), np.sin(k / 12), *[0] * (d - 2)], 2)
    same = rng.standard_normal(d)
    for k in range(30):
        add(same, 0, key=k % 7 > 0)
    add(same * 1e30, 0)
    add(same * 1e-30, 0)
    add(same, None)
    add(-same, 0)
    add(None, 1)
    add([], 1)
    add([0.0] * d, 1)
    add([-0.0, 1.0], 1)
    add([0.0, 1.0], 1)
    add([0.0, 1.0, 0.0], 1)
    add([float("nan")] + [1.0] * (d - 1), 1)
    add([float("inf")] + [1.0] * (d - 1), 1)
    rows.append((900, [None, 1.0], 1))
    rows.append((3, rows[3][1], rows[3][2]))  # a repeated row
    lone = rng.standard_normal(d)
    for _ in range(2):
        add(lone, 5, key=False)
    return rows


@pytest.mark.parametrize("list_size", [4, 10])
def test_every_link(spark, list_size):
    rows = _vectors()
    vectors = spark.createDataFrame([r + (1, 2, 3, 4, 0.5, 6) for r in rows], SCHEMA).repartition(4)
    got = neighbours.near_copies(vectors, list_size=list_size)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = _all_pairs(rows)
    # a component without any id keeps all its rows
    want = [(k, n, c, True if k is None and c is None else kept) for k, n, c, kept in want]
    assert _order(tuple(r) for r in got.collect()) == _order(want)


def test_large_blocks_and_double_precision(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    rows = [r for r in _vectors() if r[1] and len(r[1]) == 8]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = neighbours.near_copies(vectors, list_size=3)
    want = _all_pairs([(k, [np.float64(c) for c in x], y) for k, x, y in rows])
    links = {(r.vec_id, r.n_links) for r in got.collect() if r.vec_id is not None}
    assert links == {(k, n) for k, n, *_ in want if k is not None}


def test_empty_and_useless(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neighbours.near_copies(nothing).count() == 0
    only = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, neighbours.near_copies(only).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError):
        neighbours.near_copies(nothing, threshold=1.0)


def test_descent_finds_what_the_seeds_missed(spark, monkeypatch):
    """With one poor table of seeds the rounds find most links, and the audit goes on until nearly all are found."""
    monkeypatch.setattr(neighbours, "TABLES", 1)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((400, 12))
    near = base[:150] + 0.05 * rng.standard_normal((150, 12))
    rows = [(k, [float(c) for c in x], 0) for k, x in enumerate(np.concatenate([base, near]))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = sum(n for _, n, _, _ in _all_pairs(rows))
    monkeypatch.setattr(neighbours, "ROUNDS", 0)
    seeded = neighbours.near_copies(vectors, target=0.0).agg({"n_links": "sum"}).first()[0]
    monkeypatch.setattr(neighbours, "ROUNDS", 6)
    found = neighbours.near_copies(vectors, target=0.0).agg({"n_links": "sum"}).first()[0]
    assert seeded < 0.9 * want
    assert found >= 0.95 * want
    assert neighbours.near_copies(vectors).agg({"n_links": "sum"}).first()[0] >= 0.98 * want


def test_query_recall(spark):
    """Links of the registered query for ids divisible by 20, against all rows."""
    got = {r.vec_id: r for r in op12_embedding_neighbours(spark, SF01).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = {k: (n, c) for k, n, c, _ in _all_pairs(rows)}
    asked = [k for k in want if k % 20 == 0]
    assert all(got[k].n_links <= want[k][0] for k in want)
    assert sum(got[k].n_links for k in asked) >= 0.98 * sum(want[k][0] for k in asked)
