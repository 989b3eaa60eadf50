"""Sums and means that do not depend on the order or the dealing of rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from blotter.operators import exact_mean, exact_sum


def _bits(x):
    return None if x is None else "nan" if math.isnan(x) else float(x).hex()


def _rows():
    rng = random.Random(4)
    rows = [("wide", rng.uniform(-1, 1) * 2.0 ** rng.randrange(-300, 300)) for _ in range(2000)]
    rows += [("plain", round(rng.uniform(-1e5, 1e5), 2)) for _ in range(5000)]
    rows += [("cancel", x) for k in range(500) for x in (1e300 + k * 1e285, -1e300 - k * 1e285, 0.1)]
    rows += [("small", 5e-324 * k) for k in range(100)] + [("small", None), ("small", -0.0)]
    rows += [("edge", 2.0**k * s) for k in range(-1074, 1024, 7) for s in (1, -1)] + [("edge", 3.0)]
    rows += [("largest", 1.7976931348623157e308), ("largest", -1.7976931348623157e308), ("largest", 0.5)]
    rows += [("up", math.inf), ("up", 1.0), ("both", math.inf), ("both", -math.inf), ("nan", math.nan), ("nan", math.inf)]
    rows += [("null", None), ("null", None), (None, 1.5), (None, 2.5), ("zero", 0.0)]
    return rows


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame(_rows(), "g string, x double").cache()


def test_close_to_the_true_sum(values):
    got = {r.g: r for r in exact_sum(values, ["g"], "x").collect()}
    groups = {}
    for g, x in _rows():
        groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        there = [x for x in xs if x is not None]
        assert (got[g].n, got[g].rows) == (len(there), len(xs))
        if not there:
            assert got[g]["sum"] is None
        elif all(map(math.isfinite, there)):
            want = float(sum(map(Fraction, there)))
            assert math.isclose(got[g]["sum"], want, rel_tol=4e-16, abs_tol=0), g
    assert math.isinf(got["up"]["sum"]) and math.isnan(got["both"]["sum"]) and math.isnan(got["nan"]["sum"])


def test_bit_equal_over_partitionings(values):
    seen = set()
    plain = set()
    for n in (1, 7, 200):
        dealt = values.repartition(n, F.rand(n))
        got = exact_mean(dealt, ["g"], "x").collect()
        seen.add(frozenset((r.g, _bits(r.avg), r["count"]) for r in got))
        plain.add(frozenset((r.g, _bits(r.a)) for r in dealt.groupBy("g").agg(F.avg("x").alias("a")).collect()))
    assert len(seen) == 1
    assert len(plain) > 1  # what the plain mean does


def test_hash_aggregate_names_and_rounding(spark):
    from blotter.plans import physical_section

    df = spark.createDataFrame([("a", "x.1", 0.1), ("a", "x.1", 0.2), ("b", "y", None)], "`k.1` string, sum string, v double")
    out = exact_mean(df, ["`k.1`", "sum"], "v", "m", "n", digits=3)
    assert out.columns == ["k.1", "sum", "m", "n"]
    assert sorted(map(tuple, out.collect())) == [("a", "x.1", 0.15, 2), ("b", "y", None, 1)]
    assert "SortAggregate" not in physical_section(exact_sum(df, ["`k.1`"], "v"))
    assert exact_sum(df.limit(0), ["sum"], "v").count() == 0
