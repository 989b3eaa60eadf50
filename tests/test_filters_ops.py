from pyspark.sql import functions as F

from blotter.operators import (
    avg_and_count,
    bottom_k,
    count_by,
    dedupe_first,
    mean_from_sum_count,
    top_k,
    top_n_per_group,
    union_positional,
    where_in_range,
    where_not_equal,
    where_regex,
)
from blotter.plans import has_node, physical_section


def test_not_equal_drops_nulls(spark):
    df = spark.createDataFrame([("a",), ("Null Island",), (None,)], "n string")
    assert [r.n for r in where_not_equal(df, "n", "Null Island").collect()] == ["a"]


def test_regex_is_unanchored_range_is_not(spark):
    df = spark.createDataFrame([(c,) for c in ["099", "100", "199", "200", "2100", "", None]], "c string")
    assert sorted(r.c for r in where_regex(df, "c", "1..").collect()) == ["100", "199", "2100"]
    ints = df.withColumn("c", F.col("c").try_cast("int"))
    assert sorted(r.c for r in where_in_range(ints, "c", 100, 200).collect()) == [100, 199]


def test_union_is_positional_first_names_win(spark):
    a = spark.createDataFrame([(1, "x")], ["k", "AREA "])
    b = spark.createDataFrame([(2, "y")], ["k", "AREA"])
    out = union_positional(a, b)
    assert out.columns == ["k", "AREA "]
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_top_n_per_group_positions_and_ties(spark):
    rows = [(2020, m, c) for m, c in [(1, 10), (2, 9), (3, 8), (4, 8), (5, 1)]]
    df = spark.createDataFrame(rows, "year int, month int, n long")
    pos = top_n_per_group(df, ["year"], [F.col("n").desc(), F.col("month").asc()], 3)
    assert [(r.month, r.rank) for r in pos.orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 3)]
    ties = top_n_per_group(df, ["year"], [F.col("n").desc()], 3, method="rank")
    assert sorted((r.month, r.rank) for r in ties.collect()) == [(1, 1), (2, 2), (3, 3), (4, 3)]
    assert has_node(pos, "WindowGroupLimit")


def test_top_and_bottom_k(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, None), (5, 1)], "zip int, income int")
    assert [r.zip for r in top_k(df, "income", 3, tie="zip").collect()] == [2, 3, 1]
    assert [r.zip for r in bottom_k(df, "income", 3, tie="zip").collect()] == [5, 1, 3]
    small = df.limit(2)
    assert len(top_k(small, "income", 3).collect()) == 2
    assert "TakeOrderedAndProject" in physical_section(top_k(df, "income", 3))


def test_avg_equals_sum_over_count(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.5), ("b", None), ("b", 4.0)], "k string, v double")
    a = {r.k: (r.avg, r["count"]) for r in avg_and_count(df, ["k"], "v", digits=6).collect()}
    b = {r.k: (r.avg, r["count"]) for r in mean_from_sum_count(df, ["k"], "v", digits=6).collect()}
    assert a == b == {"a": (1.75, 2), "b": (4.0, 2)}


def test_dedupe_first_keeps_lowest_and_limits_groups_map_side(spark):
    df = spark.createDataFrame([("x", 3, "c"), ("x", 1, "a"), ("y", 2, "b"), ("x", 2, "b")], "key string, id int, t string")
    out = dedupe_first(df, ["key"], "id")
    assert sorted((r.key, r.id, r.t) for r in out.collect()) == [("x", 1, "a"), ("y", 2, "b")]
    plan = physical_section(out)
    assert plan.count("WindowGroupLimit") >= 2  # before and after the exchange


def test_dedupe_first_puts_null_order_last(spark):
    df = spark.createDataFrame([("a", None, "n"), ("a", 5, "five"), ("b", None, "only")], "key string, o int, t string")
    got = sorted((r.key, r.o, r.t) for r in dedupe_first(df, ["key"], "o").collect())
    assert got == [("a", 5, "five"), ("b", None, "only")]


def test_count_by(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted((r.k or "", r.n) for r in count_by(df, ["k"], "n").collect()) == [("", 1), ("a", 2)]
