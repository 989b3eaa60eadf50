"""The incident files' path end to end: CSV → header repair → union → questions,
and the same questions over the Parquet conversion."""

from blotter.functions import to_int
from blotter.questions import day_segment_counts, peak_months, peak_months_sql, station_distance
from blotter.session import scratch_path
from blotter.sources import csv_to_parquet, read_csv
from tests.test_sources import incident_files  # noqa: F401  (fixture)


def _incidents(spark, paths):
    a = read_csv(spark, paths[0], repair_headers=True)
    b = read_csv(spark, paths[1], repair_headers=True)
    return a, b


def test_questions_over_csv_and_parquet_agree(spark, incident_files):  # noqa: F811
    a, b = _incidents(spark, incident_files)
    q1_csv = [tuple(r) for r in peak_months(a, b).collect()]
    assert q1_csv == [(None, None, 1, 1), (2020, 3, 2, 1), (2021, 1, 1, 1)]
    assert [tuple(r) for r in peak_months_sql(spark, a, b).collect()] == q1_csv

    pa = csv_to_parquet(spark, incident_files[0], scratch_path(spark, "a-pq"))
    pb = csv_to_parquet(spark, incident_files[1], scratch_path(spark, "b-pq"))
    assert [tuple(r) for r in peak_months(pa, pb).collect()] == q1_csv

    facts = a.unionByName(b)
    q2 = {r.day_seg: r["count"] for r in day_segment_counts(facts, to_int("TIME OCC")).collect()}
    assert q2 == {"night": 2, "afternoon": 1}


def test_q4_over_csv(spark, incident_files):  # noqa: F811
    a, b = _incidents(spark, incident_files)
    stations = spark.createDataFrame(
        [("-118.3210", "34.0610", "1", "MIDTOWN", "x", "7"), ("-118.2150", "34.0290", "2", "HARBORVIEW", "y", "1")],
        "X string, Y string, FID string, DIVISION string, LOCATION string, PREC string",
    )
    out = {r.division: r["incidents total"] for r in station_distance(a.union(b), stations).collect()}
    # codes 102 (area 01) and 199 (area 7) are in [100, 200); '' and 2100 are not
    assert out == {"HARBORVIEW": 1, "MIDTOWN": 1}
    regex = {r.division: r["incidents total"]
             for r in station_distance(a.union(b), stations, code_range=None, code_pattern="1..").collect()}
    assert regex == {"HARBORVIEW": 1, "MIDTOWN": 1}


def test_cli_runs_each_question(spark, incident_files, tmp_path):  # noqa: F811
    from blotter import cli

    stations = tmp_path / "stations.csv"
    stations.write_text("X,Y,FID,DIVISION,LOCATION,PREC\n-118.3210,34.0610,1,MIDTOWN,12 ELM ST.,7\n")
    places = tmp_path / "places.csv"
    places.write_text("LAT,LON,ZIPcode\n41.2875,-70.4410,90001\n34.05,-118.25,90002\n")
    incomes = tmp_path / "incomes.csv"
    incomes.write_text('Zip Code,Community,Estimated Median Income\n90001,Los Angeles,"$1,000"\n90002,Los Angeles,"$2,000"\n')
    parser = cli._parser()
    runs = {
        "q1": ["q1", "--incidents", *incident_files],
        "q1sql": ["q1", "--incidents", *incident_files, "--sql", "--rank"],
        "q2": ["q2", "--incidents", *incident_files],
        "q3": ["q3", "--incidents", incident_files[0], "--places", str(places), "--incomes", str(incomes)],
        "q4": ["q4", "--incidents", *incident_files, "--stations", str(stations)],
    }
    out = {k: cli.run(parser.parse_args(v), spark).collect() for k, v in runs.items()}
    assert len(out["q1"]) == 3 and len(out["q1sql"]) == 3
    assert {r.day_seg for r in out["q2"]} == {"night", "afternoon"}
    assert sorted((r.tag, r["victim descent"], r["total victims"]) for r in out["q3"]) == [
        ("highest", "Unknown", 1), ("highest", "White", 1), ("lowest", "Unknown", 1), ("lowest", "White", 1)]
    assert [(r.division, r["incidents total"]) for r in out["q4"]] == [("MIDTOWN", 1)]
