"""Clustered files, one-pass size checks, the reject ledger, scratch folders."""

import os

import pytest
from pyspark.sql import functions as F

from blotter.operators import join_with_strategy
from blotter.plans import RejectLedger, broadcast_if_small, physical_section
from blotter.functions import parse_timestamp, to_int
from blotter.session import checkpoint_root, local_path, remove_old_scratch, scratch, scratch_path
from blotter.sources import csv_to_parquet, read_csv, write_clustered, write_csv


def _scan_metrics(df):
    """Metrics of the one file scan of a plan without shuffles, after running it."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaf = plan.collectLeaves().head()
    return {k: leaf.metrics().apply(k).value() for k in ("numFiles", "numOutputRows")}


@pytest.fixture(scope="module")
def events(spark):
    """A third of the rows in one year, and within it a third on one code."""
    n = F.col("id")
    return spark.range(30_000, numPartitions=6).select(
        n,
        F.when(n % 3 == 0, 2020).otherwise(2010 + n % 10).alias("y"),
        F.when(n % 9 == 0, 7).otherwise(n * 7919 % 5000).alias("code"),
    )


def test_folders_and_ranges_are_skipped(spark, events):
    path = scratch_path(spark, "clustered")
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = write_clustered(events, path, {"year": F.col("y").cast("int")}, ["code"], row_group_bytes=4096)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
    assert stored.columns == ["id", "y", "code", "year"]
    assert stored.exceptAll(events.withColumn("year", F.col("y").cast("int"))).count() == 0 and stored.count() == 30_000
    everything = _scan_metrics(stored)
    assert everything["numOutputRows"] == 30_000
    one_year = _scan_metrics(stored.where("year = 2020"))
    assert one_year["numFiles"] < everything["numFiles"] / 2 and one_year["numOutputRows"] == 10_000
    some = stored.where("year = 2020 and code >= 100 and code < 150")
    assert "PushedFilters: [IsNotNull(code), GreaterThanOrEqual(code,100)" in physical_section(some)
    assert _scan_metrics(some)["numOutputRows"] < 5_000  # whole files and row groups are skipped
    # the large folder, and the large value in it, are several files
    files = stored.where("code = 7").select(F.input_file_name().alias("f")).distinct().count()
    assert files >= 2


def test_clustered_conversion_of_csv(spark, events):
    source = scratch_path(spark, "clustered-csv")
    write_csv(events.select("id", "code", F.col("y").cast("string").alias("DATE ")), source, header=True)
    stored = csv_to_parquet(
        spark, source, scratch_path(spark, "clustered-parquet"), partition_by={"year": to_int("DATE")}, sort_by=["code"]
    )
    assert dict(stored.dtypes) == {"id": "string", "code": "string", "DATE": "string", "year": "int"}
    assert stored.where("year = 2013").count() == events.where("y = 2013").count()
    with pytest.raises(ValueError, match="already"):
        write_clustered(events, scratch_path(spark, "clash"), {"CODE": F.col("y")})


def test_folder_of_missing_values(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "k int, t string")
    stored = write_clustered(rows, scratch_path(spark, "nulls"), {"n": to_int("t")}, ["k"])
    assert sorted(r.k for r in stored.where("n is null").collect()) == [1, 2]


def test_dimension_is_read_once(spark):
    source = scratch_path(spark, "dimension-source")
    spark.range(50).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(source)
    dim = spark.read.parquet(source)
    facts = spark.range(500).select((F.col("id") % 70).alias("k"))
    out = join_with_strategy(facts, dim, "k", "broadcast", max_broadcast_rows=50)
    assert out.count() == facts.where("k < 50").count()
    # the join reads the copy whose size was observed while it was written
    assert os.path.basename(source) not in physical_section(out)
    assert not broadcast_if_small(dim, max_rows=49)[1]
    assert not broadcast_if_small(dim, max_rows=50, max_bytes=400)[1]
    assert broadcast_if_small(dim, max_rows=50, max_bytes=50 * 9)[1]


def test_ledger_counts_what_parsing_lost(spark):
    rows = [("03/17/2020 12:00:00 AM", "07"), ("no date", "x"), (None, "y"), ("", None), ("03/18/2020 01:00:00 PM", "")]
    df = spark.createDataFrame(rows, "d string, n string").repartition(3)
    ledger = RejectLedger("test")
    watched = ledger.watch(df, {"date": (F.col("d"), parse_timestamp("d")), "number": (F.col("n"), to_int("n"))})
    answer = watched.where(parse_timestamp("d").isNotNull()).count()
    assert answer == 2
    assert ledger.counts() == {"rows": 5, "date": 2, "number": 3}
    with pytest.raises(ValueError):
        ledger.watch(df, {"date": (F.col("d"), F.col("d"))})
    with pytest.raises(ValueError):
        RejectLedger().watch(df, {"rows": (F.col("d"), F.col("d"))})


def test_scratch_goes_with_its_block(spark):
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch(spark):
        gone = scratch_path(spark, "gone")
        spark.range(3).write.parquet(gone)
        scratch_path(spark, "never-written")
        assert os.path.exists(local_path(gone))
    assert not os.path.exists(local_path(gone)) and os.path.exists(local_path(kept))
    with pytest.raises(RuntimeError), scratch(spark):
        failed = scratch_path(spark, "failed")
        spark.range(3).write.parquet(failed)
        raise RuntimeError
    assert not os.path.exists(local_path(failed))


def test_old_scratch(spark):
    old = scratch_path(spark, "old")
    spark.range(3).write.parquet(old)
    day = 24 * 3600
    before = os.path.getmtime(local_path(old)) - 2 * day
    os.utime(local_path(old), (before, before))
    young = scratch_path(spark, "young")
    spark.range(3).write.parquet(young)
    removed = remove_old_scratch(spark, 24)
    assert [os.path.basename(p) for p in removed] == [os.path.basename(old)]
    assert os.path.exists(local_path(young)) and local_path(young).startswith(local_path(checkpoint_root(spark)))
    with pytest.raises(ValueError):
        remove_old_scratch(spark, 0)


def test_csv_read_back_unchanged_by_scratch(spark):
    with scratch(spark):
        path = scratch_path(spark, "block-csv")
        write_csv(spark.range(4), path, header=True)
        rows = read_csv(spark, path).collect()
    assert sorted(r.id for r in rows) == ["0", "1", "2", "3"]
