from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.functions import to_int
from blotter.questions import (
    day_segment_counts,
    descent_breakdown,
    peak_months,
    peak_months_sql,
    station_distance,
)
from blotter.sources import inline_table
from tests.test_functions import _vincenty_reference


def _incidents_by_month(spark):
    # 2019: Jan 4, Feb 3, Mar 2, Apr 2 (tie at positions 3/4), May 1; 2020: Jan 1
    counts = {(2019, 1): 4, (2019, 2): 3, (2019, 3): 2, (2019, 4): 2, (2019, 5): 1, (2020, 1): 1}
    rows = []
    for (y, m), n in counts.items():
        rows += [(f"{m:02d}/1{i}/{y} 0{i + 1}:00:00 PM",) for i in range(n)]
    rows.append(("bad date",))
    return spark.createDataFrame(rows, "`DATE OCC` string")


def test_q1_positions_dataframe_equals_sql(spark):
    df = _incidents_by_month(spark)
    a = [tuple(r) for r in peak_months(df).collect()]
    b = [tuple(r) for r in peak_months_sql(spark, df).collect()]
    assert a == b == [(None, None, 1, 1), (2019, 1, 4, 1), (2019, 2, 3, 2), (2019, 3, 2, 3), (2020, 1, 1, 1)]


def test_q1_rank_keeps_ties(spark):
    df = _incidents_by_month(spark)
    got = [tuple(r) for r in peak_months(df, method="rank").filter(F.col("year") == 2019).collect()]
    assert got == [(2019, 1, 4, 1), (2019, 2, 3, 2), (2019, 3, 2, 3), (2019, 4, 2, 3)]
    sql = [tuple(r) for r in peak_months_sql(spark, df, method="rank").filter(F.col("year") == 2019).collect()]
    assert sql == got


def test_q1_unions_inputs_by_position(spark):
    df = _incidents_by_month(spark)
    other = spark.createDataFrame([("01/01/2019 01:00:00 AM",)], "`Date Occ ` string")
    got = {(r.year, r.month): r.crime_total for r in peak_months(df, other).collect()}
    assert got[(2019, 1)] == 5


def test_q2_forms_agree(spark):
    rows = [("STREET", t) for t in ["0000", "0459", "0500", "1159", "1200", "1659", "1700", "2059", "2100", "2359"]]
    rows += [("PARK", "1000"), ("STREET", None)]
    df = spark.createDataFrame(rows, "`Premis Desc` string, `TIME OCC` string")
    hhmm = to_int("TIME OCC")
    a = [tuple(r) for r in day_segment_counts(df, hhmm).collect()]
    b = [tuple(r) for r in day_segment_counts(df, hhmm, pairs=True).collect()]
    assert a == b
    assert dict(a) == {"night": 4, "morning": 2, "afternoon": 2, "evening": 2, None: 1}


def _q3_fixture(spark):
    incomes = spark.createDataFrame(
        [
            ("90001", "Los Angeles", "$1,234"),
            ("90002", "Los Angeles", "$999"),
            ("90003", "Los Angeles (Watts)", "$1,234,567"),
            ("90004", "Los Angeles", "$55,000"),
            ("90005", "Los Angeles", "$55,000"),
            ("90006", "Pasadena", "$9,999,999"),
            ("90007", "Los Angeles", ""),
            ("90008", "Los Angeles", "$20,000"),
        ],
        "`Zip Code` string, Community string, `Estimated Median Income` string",
    )
    places = spark.createDataFrame(
        [
            ("41.2875", "-70.45", "90003"),
            ("41.2875", "-70.45", "90003"),   # repeated pair
            ("41.28750", "-70.45", "90002"),  # differs as text only
            ("34.1", "-118.2", "90004"),
            ("34.2", "-118.2", "90005"),
            ("34.3", "-118.2", "90001"),
            ("34.4", "-118.2", "90006"),
            (None, "-118.2", "90001"),
        ],
        "LAT string, LON string, `Zip Code` string",
    )
    facts = spark.createDataFrame(
        [
            ("41.2875", "-70.45", "W"), ("41.2875", "-70.45", "W"), ("41.2875", "-70.45", "H"),
            ("41.28750", "-70.45", "B"), ("34.1", "-118.2", "W"), ("34.2", "-118.2", "X"),
            ("34.3", "-118.2", "H"), ("34.3", "-118.2", None), ("34.4", "-118.2", "W"),
            ("34.3", "-118.2", "Q"),  # code without text
        ],
        "LAT string, LON string, `Vict Descent` string",
    )
    codes = inline_table(spark, [("B", "Black"), ("H", "Hispanic/Latin/Mexican"), ("W", "White"), ("X", "Unknown")],
                         ["Vict Descent", "Vict Descent text"])
    return facts, places, incomes, codes


def _q3_brute_force(facts, places, incomes, codes, k=3):
    def money(s):
        try:
            return int(s[1:].replace(",", ""))
        except (TypeError, ValueError):
            return None

    la = [(z, money(t)) for z, c, t in incomes if "Los Angeles" in c and money(t) is not None]
    ordered = sorted(la, key=lambda zt: (-zt[1], zt[0]))
    groups = {"highest": {z for z, _ in ordered[:k]}, "lowest": {z for z, _ in ordered[::-1][:k]}}
    zip_of = {}
    for lat, lon, z in places:
        if lat is not None and lon is not None:
            zip_of.setdefault((lat, lon), z)
    text = dict(codes)
    out = Counter()
    for lat, lon, d in facts:
        if d is None or (lat, lon) not in zip_of or d not in text:
            continue
        for tag, zips in groups.items():
            if zip_of[(lat, lon)] in zips:
                out[(tag, text[d])] += 1
    return out


def test_q3_matches_brute_force(spark):
    facts, places, incomes, codes = _q3_fixture(spark)
    want = _q3_brute_force(
        [tuple(r) for r in facts.collect()], [tuple(r) for r in places.collect()],
        [tuple(r) for r in incomes.collect()], [tuple(r) for r in codes.collect()],
    )
    for determined in (False, True):
        got = descent_breakdown(facts, places, incomes, codes, key_determines_zip=determined)
        rows = got.collect()
        assert Counter({(r.tag, r["victim descent"]): r["total victims"] for r in rows}) == want
        # most first within each group
        for tag in ("highest", "lowest"):
            totals = [r["total victims"] for r in rows if r.tag == tag]
            assert totals == sorted(totals, reverse=True)


def test_q4_matches_brute_force(spark):
    incidents = spark.createDataFrame(
        [
            ("01", "Harborview", "102", "34.05", "-118.25"),
            ("01", "Harborview", "199", "34.06", "-118.24"),
            ("07", "Midtown", "100", "41.2875", "-70.4410"),
            ("07", "Midtown", "2100", "41.2875", "-70.4410"),  # regex-only code
            ("07", "Midtown", None, "41.2875", "-70.4410"),
            ("07", "Null Island", "150", "0", "0"),
            ("14", "Pacific", "150", "33.99", "-118.42"),        # no station
            ("07", "Midtown", "150", "0", "0"),                  # (0, 0) kept by default
        ],
        "AREA string, `AREA NAME` string, `Weapon Used Cd` string, LAT string, LON string",
    )
    stations = spark.createDataFrame(
        [("-118.2150", "34.0290", "1", "HARBORVIEW", "40 OAK AVE.", "1"),
         ("-118.3210", "34.0610", "2", "MIDTOWN", "12 ELM ST.", "7")],
        "X string, Y string, FID string, DIVISION string, LOCATION string, PREC string",
    )
    got = {r.division: (r.average_distance, r["incidents total"]) for r in station_distance(incidents, stations).collect()}
    harborview = [_vincenty_reference(34.05, -118.25, 34.0290, -118.2150), _vincenty_reference(34.06, -118.24, 34.0290, -118.2150)]
    midtown = [_vincenty_reference(41.2875, -70.4410, 34.0610, -118.3210), _vincenty_reference(0, 0, 34.0610, -118.3210)]
    assert got["HARBORVIEW"][1] == 2 and abs(got["HARBORVIEW"][0] - sum(harborview) / 2) < 1e-9
    assert got["MIDTOWN"][1] == 2 and abs(got["MIDTOWN"][0] - sum(midtown) / 2) < 1e-9
    assert set(got) == {"HARBORVIEW", "MIDTOWN"}
    dropped = {r.division: r["incidents total"] for r in station_distance(incidents, stations, drop_zero_coordinates=True).collect()}
    assert dropped == {"HARBORVIEW": 2, "MIDTOWN": 1}
    regex = {r.division: r["incidents total"] for r in station_distance(incidents, stations, code_range=None, code_pattern="1..").collect()}
    assert regex == {"HARBORVIEW": 2, "MIDTOWN": 3}


def test_q1_sql_leaves_no_temp_view(spark):
    before = {t.name for t in spark.catalog.listTables()}
    out = peak_months_sql(spark, _incidents_by_month(spark))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert len(out.collect()) == 5


def test_q3_without_broadcast_gives_same_result(spark):
    facts, places, incomes, codes = _q3_fixture(spark)
    a = descent_breakdown(facts, places, incomes, codes, key_determines_zip=True)
    b = descent_breakdown(facts, places, incomes, codes, key_determines_zip=True, max_broadcast_rows=0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_q3_join_strategies_agree_and_are_planned(spark):
    from blotter.plans import join_strategies

    facts, places, incomes, codes = _q3_fixture(spark)
    base = sorted(map(tuple, descent_breakdown(facts, places, incomes, codes).collect()))
    expected_node = {"broadcast": "BroadcastHashJoin", "shuffle_hash": "ShuffledHashJoin", "merge": "SortMergeJoin"}
    for strategy, node in expected_node.items():
        out = descent_breakdown(facts, places, incomes, codes, strategy=strategy)
        assert sorted(map(tuple, out.collect())) == base
        plan = join_strategies(out)
        assert plan[:2] == [node, node], (strategy, plan)


def test_q3_takes_one_strategy_per_join(spark):
    from blotter.plans import join_strategies

    facts, places, incomes, codes = _q3_fixture(spark)
    base = sorted(map(tuple, descent_breakdown(facts, places, incomes, codes).collect()))
    mixed = {"zips": "broadcast", "places": "shuffle_hash", "codes": "broadcast"}
    out = descent_breakdown(facts, places, incomes, codes, strategy=mixed)
    assert sorted(map(tuple, out.collect())) == base
    assert join_strategies(out)[:2] == ["BroadcastHashJoin", "ShuffledHashJoin"]
    merged = descent_breakdown(facts, places, incomes, codes, strategy=dict.fromkeys(mixed, "merge"))
    assert sorted(map(tuple, merged.collect())) == base
    assert join_strategies(merged)[:2] == ["SortMergeJoin", "SortMergeJoin"]
    with pytest.raises(ValueError):
        descent_breakdown(facts, places, incomes, codes, strategy={"facts": "merge"})
    with pytest.raises(ValueError):
        descent_breakdown(facts, places, incomes, codes, strategy={"zips": "shuffle_replicate_nl"})


def test_q3_broadcast_raises_past_its_bound(spark):
    facts, places, incomes, codes = _q3_fixture(spark)
    with pytest.raises(ValueError):
        descent_breakdown(facts, places, incomes, codes, strategy="broadcast", max_broadcast_rows=0)


@pytest.mark.parametrize("group", ["highest", "lowest"])
def test_q3_one_group_equals_that_part_of_both(spark, group):
    facts, places, incomes, codes = _q3_fixture(spark)
    both = descent_breakdown(facts, places, incomes, codes).collect()
    alone = descent_breakdown(facts, places, incomes, codes, groups=[group]).collect()
    assert sorted(map(tuple, alone)) == sorted(tuple(r) for r in both if r["tag"] == group)


def test_q1_counts_undated_rows_of_both_files(spark):
    old = spark.createDataFrame([("02/03/2011 01:00:00 PM",), (None,)], "`DATE OCC` string")
    new = spark.createDataFrame([("02/04/2011 01:00:00 AM",), (None,)], "`DATE OCC` string")
    rows = {(r["year"], r["month"]): r["crime_total"] for r in peak_months(old, new).collect()}
    assert rows == {(2011, 2): 2, (None, None): 2}


def test_q3_with_no_matching_community_is_empty(spark):
    facts, places, incomes, codes = _q3_fixture(spark)
    out = descent_breakdown(facts, places, incomes, codes, community="Nowhere")
    assert out.collect() == []
    assert out.columns == ["tag", "victim descent", "total victims"]


def test_tables_and_sql_stay_in_their_session(spark):
    from blotter.catalog import QUERIES
    from tests.conftest import SF001

    other = spark.newSession()
    a = QUERIES["q1_sql"](spark, SF001)
    b = QUERIES["q1_sql"](other, SF001)
    assert b.sparkSession is other
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]


def test_coordinates_that_read_alike_when_joined(spark):
    """('1 2', '3') and ('1', '2 3') are two places; of several text zips the smallest counts, with a hash aggregate."""
    from blotter.plans import has_node

    facts = spark.createDataFrame(
        [("1 2", "3", "W"), ("1", "2 3", "W"), ("5", "5", "W"), ("6", "6", "B"), ("7", "7", "B")],
        "LAT string, LON string, `Vict Descent` string",
    )
    places = spark.createDataFrame(
        [("1 2", "3", "90001"), ("1", "2 3", "90002"), ("5", "5", "90002"), ("5", "5", "89999"), ("6", "6", "90001"),
         ("6", "6", "90001-5"), ("7", "7", None), ("7", "7", "90002"), (None, "7", "90001")],
        "LAT string, LON string, `Zip Code` string",
    )
    incomes = spark.createDataFrame(
        [("90001", "Los Angeles (A)", "$50,000"), ("90002", "Los Angeles (B)", "$40,000"), (None, "Los Angeles", "$1")],
        "`Zip Code` string, Community string, `Estimated Median Income` string",
    )
    codes = spark.createDataFrame([("W", "White"), ("B", "Black")], "`Vict Descent` string, `Vict Descent text` string")
    for k, want in ((1, {("highest", "White"): 1, ("highest", "Black"): 1}), (2, None)):
        got = descent_breakdown(facts, places, incomes, codes, k=k)
        rows = {(r.tag, r["victim descent"]): r["total victims"] for r in got.collect()}
        if want is None:  # 90001 and 90002 are both among the highest two; the coordinate 5, 5 belongs to 89999
            assert rows[("highest", "White")] == 2 and rows[("highest", "Black")] == 2
        else:
            assert rows == want
    seen = []
    from blotter import questions

    original = questions.materialise
    questions.materialise = lambda df, label: (seen.append(df), original(df, label))[1]
    try:
        descent_breakdown(facts, places, incomes, codes)
    finally:
        questions.materialise = original
    assert not has_node(seen[-1], "SortAggregate")


def test_exact_mean_distance_is_bit_equal(spark):
    incidents = spark.range(3000).select(
        F.lit("1").alias("AREA"), F.lit("x").alias("AREA NAME"), F.lit("150").alias("Weapon Used Cd"),
        (F.lit(34.0) + F.col("id") * 0.0001).cast("string").alias("LAT"),
        (F.lit(-118.0) - F.col("id") * 0.00017).cast("string").alias("LON"),
    )
    stations = spark.createDataFrame([("-118.2", "34.1", "HARBORVIEW", "01")], "X string, Y string, DIVISION string, PREC string")
    got = {
        station_distance(incidents.repartition(n, F.rand(n)), stations, exact=True).first().average_distance.hex()
        for n in (1, 7, 200)
    }
    plain = station_distance(incidents, stations).first().average_distance
    assert len(got) == 1 and abs(float.fromhex(got.pop()) - plain) < 1e-9
