"""Joins that look at frequent keys and at the build side first."""

import collections
import statistics

import pytest
from pyspark.sql import functions as F

from blotter.operators import bounded_hash_join, frequent_keys, hot_key_join
from blotter.operators.skew import build_partitions
from blotter.plans import join_strategies


@pytest.fixture()
def fixed_tasks(spark):
    """32 shuffle partitions, and nothing that adaptive execution mends at run time."""
    conf = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def _facts(spark, n=60_000):
    """A third of the rows under key 0; ``spread`` rows are equal to many others."""
    return spark.range(n, numPartitions=8).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("k")
    )


def test_frequent_keys(spark):
    facts = _facts(spark).withColumn("a", F.col("k") % 2)
    got = frequent_keys(facts, ["k", "a"], 1000).collect()
    want = facts.where("k = 0").select(F.xxhash64("k", "a").alias("h")).first().h
    assert [r[0] for r in got] == [want]
    assert abs(got[0].n - 20_000) < 200
    assert frequent_keys(facts.limit(0), "k", 10).count() == 0


def test_a_third_on_one_key_is_spread(spark, fixed_tasks):
    facts, dim = _facts(spark), spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = hot_key_join(facts, dim, "k")
    assert out.columns == ["k", "id", "v"]
    sizes = _rows_per_task(out)
    assert sum(sizes) == 60_000
    assert max(sizes) <= 3 * statistics.median(sizes)
    plain = _rows_per_task(facts.join(dim.hint("merge"), "k"))
    assert max(plain) > 8 * statistics.median(plain)
    same = facts.join(dim, "k")
    assert out.exceptAll(same).count() == 0 and same.exceptAll(out).count() == 0
    assert join_strategies(out).count("SortMergeJoin") == 1


def test_equal_rows_are_spread_by_their_tasks(spark, fixed_tasks):
    facts = _facts(spark).select("k").repartition(64)
    dim = spark.range(997).select(F.col("id").alias("k"))
    sizes = _rows_per_task(hot_key_join(facts, dim, "k"))
    assert sum(sizes) == 60_000
    assert max(sizes) <= 5 * statistics.median(sizes)


def test_both_sides_hot(spark, fixed_tasks):
    left = spark.range(3000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    right = spark.range(900).select(F.col("id").alias("b"), F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"))
    out = hot_key_join(left, right, "k", rows_per_task=40)
    want = collections.Counter(map(tuple, left.join(right, "k").select("a", "b").collect()))
    assert collections.Counter(map(tuple, out.select("a", "b").collect())) == want
    sizes = _rows_per_task(out)
    assert max(sizes) <= 3 * statistics.median(sizes)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_nulls_copies_and_missing_keys(spark, fixed_tasks, how):
    rows = [(k, None if k % 4 == 0 else "x" if k % 4 == 1 else str(k), k % 2) for k in range(400)] * 2
    facts = spark.createDataFrame(rows, "id int, k string, j int")
    dim = spark.createDataFrame([("x", 1, "one"), ("x", 1, "one"), ("2", 0, "two"), (None, 0, "null")], "k string, j int, v string")
    out = hot_key_join(facts, dim, ["k", "j"], how, rows_per_task=10)
    want = facts.join(dim, ["k", "j"], how)
    assert out.columns == want.columns
    assert collections.Counter(map(tuple, out.collect())) == collections.Counter(map(tuple, want.collect()))


def test_without_rows(spark):
    facts = spark.createDataFrame([], "k int, a int")
    dim = spark.createDataFrame([], "k int, b int")
    assert hot_key_join(facts, dim, "k").count() == 0
    assert bounded_hash_join(facts, dim, "k").count() == 0
    with pytest.raises(ValueError):
        hot_key_join(facts, dim, "k", "full")
    with pytest.raises(ValueError):
        bounded_hash_join(facts, dim, "k", on_excess="hope")


def test_build_side_is_measured_as_it_will_be_dealt(spark, fixed_tasks):
    dim = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit("x" * 20).alias("v"))
    partitions, largest = build_partitions(dim, "k", 1 << 30, 32)
    assert partitions == 32
    dealt = dim.repartition(32, "k").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert largest == dealt * 24
    more, smaller = build_partitions(dim, "k", largest // 3, 32)
    assert more > 32 and smaller <= largest // 3


def test_more_partitions_until_the_build_side_fits(spark, fixed_tasks):
    facts, dim = _facts(spark), spark.range(997).select(F.col("id").alias("k"), F.lit("x" * 100).alias("v"))
    out = bounded_hash_join(facts, dim, "k", max_build_bytes=2500)
    assert join_strategies(out) == ["ShuffledHashJoin"]
    assert len(_rows_per_task(out)) > 32
    assert out.count() == 60_000


def test_one_build_key_beyond_the_bound(spark, fixed_tasks):
    facts = _facts(spark, 300)
    dim = spark.range(2000).select(
        F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") - 1000).alias("k"), F.col("id").alias("v")
    )
    bound = 2000  # bytes; key 0 has 1001 rows of 16
    with pytest.raises(ValueError, match="one build partition"):
        bounded_hash_join(facts, dim, "k", max_build_bytes=bound, on_excess="refuse")
    with pytest.raises(ValueError):
        bounded_hash_join(facts, dim, "k", "left", max_build_bytes=bound)
    out = bounded_hash_join(facts, dim, "k", max_build_bytes=bound)
    assert "ShuffledHashJoin" in join_strategies(out)
    want = facts.join(dim, "k")
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    with pytest.raises(ValueError, match="sort-merge"):
        bounded_hash_join(facts, dim, "k", max_build_bytes=20)


def test_left_hash_join_that_fits(spark, fixed_tasks):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, t string")
    dim = spark.createDataFrame([(1, "one"), (None, "null")], "k int, v string")
    out = bounded_hash_join(facts, dim, "k", "left")
    assert sorted(out.collect(), key=lambda r: r.t) == [(1, "a", "one"), (2, "b", None), (None, "c", None)]
