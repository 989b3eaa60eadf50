"""Property checks: each example is one DataFrame of generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.functions import currency_text, currency_to_int, day_segment, day_segment_pandas, join_key
from blotter.operators import bottom_k, dedupe_first, join_with_strategy, top_k, top_n_per_group

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-100, max_value=2500)), min_size=1, max_size=300))
def test_day_segment_native_equals_pandas(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t int")
    rows = df.select(day_segment("t").alias("a"), day_segment_pandas("t").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


@SETTINGS
@given(st.lists(st.integers(min_value=-2_000_000_000, max_value=2_000_000_000), min_size=1, max_size=300))
def test_currency_text_round_trip(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "a long")
    rows = df.select("a", currency_to_int(currency_text("a")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 20), st.integers(0, 5)), min_size=1, max_size=200),
    st.lists(st.tuples(st.integers(0, 25), st.text(max_size=3)), min_size=1, max_size=30),
)
def test_join_strategies_agree(spark, facts, dims):
    f = spark.createDataFrame(facts, "k int, v int")
    d = spark.createDataFrame(dims, "k int, name string")
    results = [
        sorted(map(tuple, join_with_strategy(f, d, "k", s).select("k", "v", "name").collect()))
        for s in (None, "broadcast", "shuffle_hash", "merge")
    ]
    expected = sorted((k, v, n) for k, v in facts for k2, n in dims if k == k2)
    assert all(r == expected for r in results)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=200))
def test_ranking_and_dedupe_match_python(spark, rows):
    df = spark.createDataFrame(rows, "g string, n int, m int")
    top = top_n_per_group(df, ["g"], [F.col("n").desc(), F.col("m").asc()], 2)
    got = sorted((r.g, r.n, r.m, r.rank) for r in top.collect())
    want = []
    for g in sorted({r[0] for r in rows}):
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want += [(g, n, m, i + 1) for i, (_, n, m) in enumerate(ordered[:2])]
    # positions among equal (n, m) pairs are interchangeable
    assert sorted((g, n, m) for g, n, m, _ in got) == sorted((g, n, m) for g, n, m, _ in want)
    first = {r.g: (r.n, r.m) for r in dedupe_first(df, ["g"], "n").collect()}
    assert first == {g: min((n, m) for gg, n, m in rows if gg == g) for g in {r[0] for r in rows}}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1000), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=100, unique_by=lambda t: t[0]))
def test_top_and_bottom_k_match_python(spark, rows):
    df = spark.createDataFrame(rows, "zip int, income int")
    valued = [r for r in rows if r[1] is not None]
    want_top = [z for z, _ in sorted(valued, key=lambda r: (-r[1], r[0]))[:3]]
    want_bottom = [z for z, _ in sorted(valued, key=lambda r: (r[1], -r[0]))[:3]]
    got_top = [r.zip for r in top_k(df, "income", 3, tie="zip").collect()][: len(want_top)]
    assert got_top == want_top
    assert [r.zip for r in bottom_k(df, "income", 3, tie="zip").collect()] == want_bottom


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="0123456789.-", max_size=6)),
                          st.one_of(st.none(), st.text(alphabet="0123456789.-", max_size=6))), min_size=1, max_size=100))
def test_join_key_is_null_iff_a_part_is_null(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", join_key("a", "b").alias("k")).collect():
        assert r.k == (None if r.a is None or r.b is None else f"{r.a} {r.b}")
