import pytest

from blotter.operators import broadcast_join, join_normalised, join_with_strategy, map_side_join, repartition_join
from blotter.plans import join_strategies

EXPECTED = {
    "broadcast": "BroadcastHashJoin",
    "shuffle_hash": "ShuffledHashJoin",
    "merge": "SortMergeJoin",
}


@pytest.fixture()
def facts_dims(spark):
    facts = spark.createDataFrame([(i, i % 5) for i in range(50)] + [(99, None)], "id int, k int")
    dims = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two"), (2, "two again"), (7, "none")], "k int, name string")
    return facts, dims


@pytest.mark.parametrize("strategy", [None, "broadcast", "shuffle_hash", "merge"])
def test_strategies_agree_and_are_planned(spark, facts_dims, strategy):
    facts, dims = facts_dims
    out = join_with_strategy(facts, dims, "k", strategy)
    rows = sorted(map(tuple, out.select("id", "k", "name").collect()))
    baseline = sorted(
        (i, i % 5, n) for i in range(50) for k, n in [(0, "zero"), (1, "one"), (2, "two"), (2, "two again")] if i % 5 == k
    )
    assert rows == baseline
    if strategy:
        assert join_strategies(out) == [EXPECTED[strategy]]


def test_broadcast_beyond_size_bound_raises(spark, facts_dims):
    facts, dims = facts_dims
    with pytest.raises(ValueError):
        join_with_strategy(facts, dims, "k", "broadcast", max_broadcast_rows=2)


def test_broadcast_join_beyond_size_bound_shuffles(spark, facts_dims):
    facts, dims = facts_dims
    rows = lambda df: sorted(map(tuple, df.select("id", "k", "name").collect()))
    within = broadcast_join(facts, dims, "k")
    assert join_strategies(within) == ["BroadcastHashJoin"]
    for join in (broadcast_join, map_side_join):
        with pytest.warns(UserWarning, match="beyond the broadcast bound"):
            beyond = join(facts, dims, "k", max_broadcast_rows=2)
        assert join_strategies(beyond) == ["SortMergeJoin"]
        assert rows(beyond) == rows(within) and len(rows(within)) == 40


def test_join_queries_run_beyond_the_broadcast_bound(spark, tmp_path):
    """More customers and suppliers than may be broadcast: every row is joined all the same."""
    from pyspark.sql import functions as F

    from blotter.catalog import QUERIES
    from blotter.plans.guards import DEFAULT_BROADCAST_ROWS

    n = DEFAULT_BROADCAST_ROWS + 1000
    key = F.col("id")
    spark.range(n).select(key.alias("c_custkey"), F.format_string("c%d", key).alias("c_name")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(n).select(key.alias("s_suppkey"), F.format_string("s%d", key).alias("s_name")).write.parquet(f"{tmp_path}/supplier.parquet")
    some = spark.range(0, 2 * n, 1000)
    some.select(key.alias("o_orderkey"), key.alias("o_custkey"), (key * 1.5).alias("o_totalprice")).write.parquet(f"{tmp_path}/orders.parquet")
    some.select(key.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), key.alias("l_suppkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = {(r.o_orderkey, r.c_name) for r in QUERIES["join_broadcast"](spark, str(tmp_path)).collect()}
    assert orders == {(k, f"c{k}") for k in range(0, n, 1000)}
    lines = {(r.l_orderkey, r.s_name) for r in QUERIES["join_map_side"](spark, str(tmp_path)).collect()}
    assert lines == {(k, f"s{k}") for k in range(0, n, 1000)}


def test_map_side_equals_repartition(spark, facts_dims):
    facts, dims = facts_dims
    a = map_side_join(facts, dims, "k")
    b = repartition_join(facts, dims, "k")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert join_strategies(a) == ["BroadcastHashJoin"] and join_strategies(b) == ["SortMergeJoin"]


def test_replicate_nl_is_refused(spark, facts_dims):
    facts, dims = facts_dims
    with pytest.raises(ValueError):
        join_with_strategy(facts, dims, "k", "shuffle_replicate_nl")


def test_normalised_key_join(spark):
    incidents = spark.createDataFrame([("01", "a"), ("07", "b"), ("14", "c"), ("x", "d"), (None, "e")], "AREA string, id string")
    stations = spark.createDataFrame([("1", "HARBORVIEW"), ("7", "MIDTOWN"), ("7", "MIDTOWN-2"), ("21", "HILLCREST")], "PREC string, DIVISION string")
    out = join_normalised(incidents, stations, "AREA", "PREC", "area")
    got = sorted((r.id, r.area, r.DIVISION) for r in out.collect())
    assert got == [("a", 1, "HARBORVIEW"), ("b", 7, "MIDTOWN"), ("b", 7, "MIDTOWN-2")]


def test_hot_key_is_split_by_adaptive_skew_join(spark):
    """One key holds a third of the facts; AQE splits its partition."""
    from pyspark.sql import functions as F

    from blotter.plans import physical_section

    n = 30_000
    facts = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).cast("int").alias("k")
    )
    dims = spark.range(997).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = repartition_join(facts, dims, "k")
        total = out.agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()[0]
        assert total.n == n
        out.collect()
        assert "skew=true" in physical_section(out)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_size_check_bounds_rows_and_bytes(spark):
    from blotter.plans import has_at_most, row_bytes

    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k int, payload string")
    assert has_at_most(wide, 100)
    assert not has_at_most(wide, 10)
    assert not has_at_most(wide, 100, max_bytes=10_000)
    per_row = wide.select(row_bytes(wide).alias("b")).first().b
    assert per_row == 4 + 1000
    out = join_with_strategy(wide, wide.select("k"), "k", "broadcast", max_broadcast_rows=100)
    assert join_strategies(out) == ["BroadcastHashJoin"]


def test_materialise_reports_rows_and_bytes(spark):
    from pyspark.sql import functions as F

    from blotter.plans import materialise, row_bytes

    df = spark.range(1000).select(F.col("id"), F.format_string("v%d", F.col("id")).alias("s"))
    back, rows, size = materialise(df, "probe")
    assert rows == back.count() == 1000
    assert size == df.agg(F.sum(row_bytes(df))).first()[0]
    assert back.dtypes == df.dtypes
    from blotter.session import local_path

    root = local_path(spark.sparkContext.getCheckpointDir())
    assert local_path(back.inputFiles()[0]).startswith(root)
