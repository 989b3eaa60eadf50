"""Plan properties the design relies on: pruning, pushdown, broadcast, codegen."""

import re

from blotter.catalog import QUERIES
from blotter.plans import join_strategies, physical_section, plan_text
from tests.conftest import SF01


def _scans(df):
    text = plan_text(df, "formatted")
    return re.findall(r"Location: InMemoryFileIndex \[[^\]]*/(\w+)\.parquet\].*?ReadSchema: (struct<[^>]*>)", text, re.S)


def test_q1_reads_one_column(spark):
    assert _scans(QUERIES["q1_df"](spark, SF01)) == [("orders", "struct<o_orderdate:timestamp_ntz>")]


def test_q2_pushes_the_premises_filter(spark):
    text = plan_text(QUERIES["q2_day_segments"](spark, SF01), "formatted")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_q3_broadcasts_places_and_reads_three_fact_columns(spark):
    df = QUERIES["q3_top"](spark, SF01)
    assert ("lineitem", "struct<l_partkey:bigint,l_suppkey:bigint,l_returnflag:string>") in _scans(df)
    df.collect()
    assert join_strategies(df) == ["BroadcastHashJoin", "BroadcastHashJoin"]


def test_q4_distance_chain_is_fused_into_generated_code(spark):
    df = QUERIES["q4_mean_distance"](spark, SF01)
    df.collect()
    projects = [ln for ln in physical_section(df).splitlines() if "Project [" in ln]
    assert len(projects) > 10
    # above the chain one projection holds the search for the few rows the chain leaves open
    assert "*(" not in projects[0]
    assert all("*(" in ln for ln in projects[1:]), "a projection fell out of whole-stage codegen"
    assert "BatchEvalPython" not in physical_section(df)


def test_range_on_a_stored_number_reaches_the_scan(spark):
    text = plan_text(QUERIES["filter_range_native"](spark, SF01))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(c_custkey,100)" in pushed and "LessThan(c_custkey,200)" in pushed
