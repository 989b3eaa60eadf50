import os
import tempfile

import pytest

from blotter.plans import physical_section
from blotter.session import local_path, scratch_path
from blotter.sources import (
    csv_to_parquet,
    file_headers,
    inline_table,
    read_csv,
    read_csv_checked,
    read_table,
    trim_headers,
    write_csv,
)

# Made-up incident rows: a header with a trailing blank, quoted commas,
# doubled quotes, two adjacent quoted fields, empty fields and a bad date.
INCIDENTS_A = (
    'DR_NO,DATE OCC,TIME OCC,AREA ,AREA NAME,Vict Descent,Premis Desc,Weapon Used Cd,LOCATION,Cross Street,LAT,LON\n'
    '1,03/17/2020 12:00:00 AM,2245,03,Lakeside,W,STREET,,"55  QUAY, RD","A ""B"" C",41.2875,-70.4410\n'
    '2,03/02/2020 12:00:00 PM,0459,01,Harborview,X,"STREET","102","X","Y",34.05,-118.25\n'
    '3,not a date,,15,North Park,,PARKING LOT,2100,,,0,0\n'
)
INCIDENTS_B = (
    'DR_NO,DATE OCC,TIME OCC,AREA,AREA NAME,Vict Descent,Premis Desc,Weapon Used Cd,LOCATION,Cross Street,LAT,LON\n'
    '4,01/15/2021 01:30:00 PM,1200,7,Midtown,H,STREET,199,1 ELM,,34.1,-118.3\n'
)


@pytest.fixture()
def incident_files():
    folder = tempfile.mkdtemp(prefix="blotter-fixture-")
    paths = []
    for name, body in (("incidents_a.csv", INCIDENTS_A), ("incidents_b.csv", INCIDENTS_B)):
        path = os.path.join(folder, name)
        with open(path, "w") as fh:
            fh.write(body)
        paths.append(path)
    return paths


def test_csv_quotes_empties_and_header_repair(spark, incident_files):
    raw = read_csv(spark, incident_files[0])
    assert "AREA " in raw.columns
    df = trim_headers(raw)
    assert "AREA" in df.columns and all(t == "string" for _, t in df.dtypes)
    rows = {r["DR_NO"]: r for r in df.collect()}
    assert rows["1"]["LOCATION"] == "55  QUAY, RD"
    assert rows["1"]["Cross Street"] == 'A "B" C'
    assert rows["1"]["Weapon Used Cd"] is None
    assert rows["2"]["Premis Desc"] == "STREET" and rows["2"]["LOCATION"] == "X"
    assert rows["3"]["TIME OCC"] is None


def test_csv_with_given_columns_runs_no_header_job(spark, incident_files):
    cols = ["DR_NO", "DATE OCC", "TIME OCC", "AREA", "AREA NAME", "Vict Descent", "Premis Desc", "Weapon Used Cd",
            "LOCATION", "Cross Street", "LAT", "LON"]
    df = read_csv(spark, incident_files, cols)
    assert df.columns == cols and df.count() == 4


def test_write_csv_round_trip_and_parquet_conversion(spark, incident_files):
    df = read_csv(spark, incident_files[0], repair_headers=True)
    out = scratch_path(spark, "roundtrip")
    write_csv(df, out, header=True)
    back = read_csv(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    target = scratch_path(spark, "converted")
    pq = csv_to_parquet(spark, incident_files, target)
    assert pq.count() == 4 and "AREA" in pq.columns
    with pytest.raises(Exception):
        csv_to_parquet(spark, incident_files, target)  # refuses to overwrite


def test_scratch_path_lives_under_checkpoint_dir(spark):
    root = spark.sparkContext.getCheckpointDir()
    p = scratch_path(spark, "x")
    assert root and p.startswith(root.rstrip("/"))
    assert os.path.isabs(local_path(p))


def test_inline_table_is_a_local_relation(spark):
    codes = inline_table(spark, [("A", "Other Asian"), ("B", "Black"), ("O'K", "quote")], ["code", "text"])
    assert sorted(r.code for r in codes.collect()) == ["A", "B", "O'K"]
    assert "LocalTableScan" in physical_section(codes)
    with pytest.raises(ValueError):
        inline_table(spark, [("A",)], ["code", "text"])


def test_schema_listing(spark):
    from blotter.plans import schema_listing

    df = spark.createDataFrame([(1, "a")], "`DR_NO` int, `AREA NAME` string")
    assert [tuple(r) for r in schema_listing(spark, df).collect()] == [("DR_NO", "int"), ("AREA NAME", "string")]


def test_descent_codes_table(spark):
    from blotter.sources import descent_codes

    codes = {r["Vict Descent"]: r["Vict Descent text"] for r in descent_codes(spark).collect()}
    assert len(codes) == 19 and codes["W"] == "White" and codes["X"] == "Unknown"


def test_cluster_conf_scales_partitions():
    from blotter.session import cluster_conf

    small = cluster_conf(10 << 30)
    big = cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_csv_keeps_blanks_empties_quotes_and_line_breaks(spark):
    values = ["  lead", "trail  ", "", None, 'a "q" b', "back\\slash", "two\nlines", "comma, here", "\t"]
    df = spark.createDataFrame([(str(k), v) for k, v in enumerate(values)], "k string, v string").coalesce(1)
    out = scratch_path(spark, "exact")
    write_csv(df, out, header=True)
    back = {r.k: r.v for r in read_csv(spark, out, multiline=True).collect()}
    assert back == {str(k): v for k, v in enumerate(values)}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b \n1,2\n")
    path = str(tmp_path / "x.csv")
    assert [tuple(r) for r in read_csv(spark, path, ["b", "a"]).collect()] == [("2", "1")]
    with pytest.raises(ValueError):
        read_csv(spark, path, ["a", "c"])


def test_read_table_sees_new_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 3
    spark.range(2).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 5


def test_checkpoint_root_needs_a_shared_folder_on_a_cluster():
    from blotter.session import _one_process

    assert _one_process("local[4]") and _one_process("local")
    assert not _one_process("local-cluster[2,1,1024]") and not _one_process("spark://host:7077")


def _files(**bodies):
    folder = tempfile.mkdtemp(prefix="blotter-fixture-")
    for name, body in bodies.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as fh:
            fh.write(body)
    return folder


def test_headers_in_another_order(spark):
    folder = _files(one="a,b\n1,2\n", two="b,a\n3,4\n", three="", four=" A , b\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, folder).collect()
    rows, rejects = read_csv_checked(spark, folder)
    assert rows.columns in (["a", "b"], ["A", "b"])
    assert sorted(map(tuple, rows.collect())) == [("1", "2"), ("4", "3")]
    assert rejects.count() == 0
    names = {os.path.basename(f): h for f, h in file_headers(spark, folder).items()}
    assert names == {"one.csv": ["a", "b"], "two.csv": ["b", "a"], "four.csv": ["A", "b"]}


def test_missing_and_doubled_columns(spark):
    folder = _files(one="a,b,c\n1,2,3\n", two="\ufeffc,a\n6,4\n")
    with pytest.raises(ValueError, match="'b'"):
        read_csv_checked(spark, folder)
    rows, _ = read_csv_checked(spark, folder, ["c", "a"])
    assert sorted(map(tuple, rows.collect())) == [("3", "1"), ("6", "4")]
    rows, _ = read_csv_checked(spark, folder, missing="null")
    assert sorted((r.a, r.b, r.c) for r in rows.collect()) == [("1", "2", "3"), ("4", None, "6")]
    doubled = _files(one="AREA ,AREA,x\n1,2,3\n")
    with pytest.raises(ValueError, match="2 times"):
        read_csv_checked(spark, doubled, ["AREA"])
    assert [r.x for r in read_csv_checked(spark, doubled, ["x"])[0].collect()] == ["3"]
    with pytest.raises(ValueError):
        read_csv_checked(spark, doubled, ["x"], missing="hope")


def test_lines_that_are_no_rows(spark):
    body = 'k,t,u\n1,a,b\n2,a\n3,a,b,c\n4,"a, ""x""",\n5,"open,b\n\n6,,""\n7\n'
    rows, rejects = read_csv_checked(spark, [_files(one=body), _files(one="u,t,k\nb,a,8\nb\n")], ["k", "u", "t"])
    good = sorted(map(tuple, rows.select("k", "t", "u").collect()))
    assert good == [("1", "a", "b"), ("4", 'a, "x"', None), ("6", None, ""), ("8", "a", "b")]
    bad = sorted((r.line, r.reason) for r in rejects.collect())
    assert bad == [
        ("2,a", "too few fields"),
        ("3,a,b,c", "too many fields"),
        ('5,"open,b', "open quote"),
        ("7", "too few fields"),
        ("b", "too few fields"),
    ]
    assert all(r.file.endswith("one.csv") for r in rejects.collect())
    # whatever is read of the rows, the same lines count
    assert rows.count() == 4 and rows.select("t").count() == 4 and rejects.select("reason").count() == 5


def test_checked_csv_without_files_of_rows(spark):
    rows, rejects = read_csv_checked(spark, _files(one=""), ["a"])
    assert rows.columns == ["a"] and rows.count() == 0 and rejects.count() == 0
