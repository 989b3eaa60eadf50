import datetime as dt
import math

from blotter.functions import (
    currency_to_int,
    day_segment,
    day_segment_pandas,
    int_or_zero,
    join_key,
    parse_hhmm,
    parse_timestamp,
    to_int,
    with_geodesic_km,
)


def _one_col(spark, values, ddl="v string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


TIMES = [0, 459, 500, 1159, 1200, 1659, 1700, 2059, 2100, 2359, None]
EXPECTED_SEGMENTS = [
    "night", "night", "morning", "morning", "afternoon", "afternoon",
    "evening", "evening", "night", "night", None,
]


def test_day_segment_bounds(spark):
    df = _one_col(spark, TIMES, "t int")
    got = [r.s for r in df.select(day_segment("t").alias("s")).collect()]
    assert got == EXPECTED_SEGMENTS


def test_day_segment_pandas_matches_native(spark):
    df = _one_col(spark, TIMES, "t int")
    rows = df.select(day_segment("t").alias("a"), day_segment_pandas("t").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_parse_timestamp_12_hour_clock_and_bad_values(spark):
    df = _one_col(spark, ["08/23/2020 12:00:00 AM", "08/23/2020 12:00:00 PM", "08/23/2020 01:30:00 PM",
                          "13/45/2020 12:00:00 AM", "", None])
    got = [r.p for r in df.select(parse_timestamp("v").alias("p")).collect()]
    assert got == [dt.datetime(2020, 8, 23, 0, 0), dt.datetime(2020, 8, 23, 12, 0),
                   dt.datetime(2020, 8, 23, 13, 30), None, None, None]
    assert dict(df.select(parse_timestamp("v").alias("p")).dtypes)["p"] == "timestamp_ntz"


def test_parse_hhmm(spark):
    df = _one_col(spark, ["2245", "0005", "", "2500", None])
    got = [r.p for r in df.select(parse_hhmm("v").alias("p")).collect()]
    assert got == [dt.datetime(1970, 1, 1, 22, 45), dt.datetime(1970, 1, 1, 0, 5), None, None, None]


def test_currency_to_int(spark):
    df = _one_col(spark, ["$1,234", "$999", "$1,234,567", "", None, "$-12", "1,234", "$", "$1,2x4"])
    got = [r.i for r in df.select(currency_to_int("v").alias("i")).collect()]
    assert got == [1234, 999, 1234567, None, None, -12, 1234, None, None]


def test_int_casts(spark):
    df = _one_col(spark, ["099", "100", "", None, "abc", "07"])
    rows = df.select(to_int("v").alias("a"), int_or_zero("v").alias("b")).collect()
    assert [r.a for r in rows] == [99, 100, None, None, None, 7]
    assert [r.b for r in rows] == [99, 100, 0, 0, None, 7]


def test_join_key_null_in_null_out(spark):
    df = spark.createDataFrame([("41.2875", "-70.45"), (None, "1"), ("41.28750", "-70.45")], "a string, b string")
    got = [r.k for r in df.select(join_key("a", "b").alias("k")).collect()]
    assert got == ["41.2875 -70.45", None, "41.28750 -70.45"]


def _vincenty_reference(lat1, lon1, lat2, lon2):
    """Textbook loop to convergence, in plain Python (independent of the column chain)."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    L = math.radians(lon2 - lon1)
    U1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    U2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    lam = L
    for _ in range(200):
        sin_sigma = math.hypot(math.cos(U2) * math.sin(lam),
                               math.cos(U1) * math.sin(U2) - math.sin(U1) * math.cos(U2) * math.cos(lam))
        if sin_sigma == 0:
            return 0.0
        cos_sigma = math.sin(U1) * math.sin(U2) + math.cos(U1) * math.cos(U2) * math.cos(lam)
        sigma = math.atan2(sin_sigma, cos_sigma)
        sin_alpha = math.cos(U1) * math.cos(U2) * math.sin(lam) / sin_sigma
        cos2_alpha = 1 - sin_alpha ** 2
        cos2sm = cos_sigma - 2 * math.sin(U1) * math.sin(U2) / cos2_alpha if cos2_alpha else 0.0
        C = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
        prev, lam = lam, L + (1 - C) * f * sin_alpha * (
            sigma + C * sin_sigma * (cos2sm + C * cos_sigma * (-1 + 2 * cos2sm ** 2)))
        if abs(lam - prev) < 1e-14:
            break
    u2 = cos2_alpha * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * sin_sigma * (cos2sm + B / 4 * (cos_sigma * (-1 + 2 * cos2sm ** 2)
                                            - B / 6 * cos2sm * (-3 + 4 * sin_sigma ** 2) * (-3 + 4 * cos2sm ** 2)))
    return b * A * (sigma - ds) / 1000.0


def _dms(d, m, s):
    return d + m / 60 + s / 3600


def test_geodesic_published_line_and_edges(spark):
    # Flinders Peak -> Buninyong, published 54 972.271 m on the ellipsoid.
    flinders = (-_dms(37, 57, 3.72030), _dms(144, 25, 29.52440))
    buninyong = (-_dms(37, 39, 10.15610), _dms(143, 55, 35.38390))
    pts = [
        (flinders[0], flinders[1], buninyong[0], buninyong[1]),
        (34.05, -118.25, 34.05, -118.25),            # equal points
        (0.0, 0.0, 0.0, 1.0),                         # one degree along the equator
        (0.0, 0.0, 41.2875, -70.4410),               # (0, 0) against a city point
        (33.9, -118.4, 34.2, -118.1),
        (None, -118.4, 34.2, -118.1),
    ]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r.km for r in with_geodesic_km(df, "a", "b", "c", "d", "km").collect()]
    assert abs(got[0] * 1000 - 54972.271) < 0.001
    assert got[1] == 0.0
    assert abs(got[2] - 6378137.0 * math.pi / 180 / 1000) < 1e-9
    for i in (3, 4):
        assert abs(got[i] - _vincenty_reference(*pts[i])) < 1e-6
    assert got[5] is None


def test_geodesic_of_opposite_points(spark):
    """Points for which the plain iteration does not converge; published lengths, symmetries, the equator."""
    pts = [
        (0.0, 0.0, 0.5, 179.5),  # 19936288.579 m, published
        (0.0, 0.0, 0.5, 179.7),  # 19944127.421 m, published
        (0.5, 179.5, 0.0, 0.0),
        (-0.5, -179.5, 0.0, 0.0),
        (0.0, 10.0, -0.5, -169.5 - 1.0),
        (0.0, 0.0, 0.0, 180.0),  # over a pole
        (90.0, 0.0, -90.0, 77.0),
        (40.0, 10.0, -40.0, -170.0),
        (0.0, 0.0, 0.0, 179.3),  # still along the equator
        (0.0, 0.0, 0.0, 179.5),  # no longer
        (0.0, -179.0, 0.0, 179.0),  # the short way round
        (1.0, 2.0, 1.0, 362.0),
        (float("nan"), 0.0, 0.0, 179.9),
        (0.0, 0.0, None, 179.9),
    ]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double").repartition(3)
    got = {(r.a, r.b, r.c, r.d): r.km for r in with_geodesic_km(df, "a", "b", "c", "d", "km").collect()}
    km = [got.get(p) for p in pts]
    half_meridian = 20003.931458625
    assert abs(km[0] * 1000 - 19936288.579) < 0.001
    assert abs(km[1] * 1000 - 19944127.421) < 0.001
    assert all(abs(x - km[0]) < 1e-9 for x in km[2:5])
    assert all(abs(x - half_meridian) < 1e-8 for x in km[5:8])
    assert abs(km[8] - 6378.137 * math.radians(179.3)) < 1e-9
    assert km[8] < km[9] < half_meridian and km[9] < 6378.137 * math.radians(179.5)
    assert abs(km[10] - 6378.137 * math.radians(2)) < 1e-6
    assert abs(km[11]) < 1e-9
    assert km[13] is None
    assert [x for x in got.values() if x is not None and math.isnan(x)]


def test_geodesic_ways_meet(spark, monkeypatch):
    """The iteration and the search by azimuth agree where both apply."""
    from blotter.functions import geodesy

    rows = [((k * 37 % 171) - 85.0, 0.0, (k * 53 % 167) - 83.0, float(k * 29 % 160)) for k in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(2)
    usual = with_geodesic_km(df, "a", "b", "c", "d", "km").collect()
    monkeypatch.setattr(geodesy, "FAR", -1.0)
    searched = {tuple(r)[:4]: r.km for r in with_geodesic_km(df, "a", "b", "c", "d", "km").collect()}
    assert all(abs(searched[tuple(r)[:4]] - r.km) < 2e-7 for r in usual)


def _halved_reference(lat1, lon1, lat2, lon2):
    """The azimuth by 80 plain halvings, integrals by Simpson's rule (independent of the columns)."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    far, close = (lat1, lat2) if abs(lat1) >= abs(lat2) else (lat2, lat1)
    b1, b2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (-abs(far), -close if far > 0 else close))
    lon = abs(math.radians((lon2 - lon1 + 180) % 360 - 180))
    weights = [1, *[4, 2] * 99, 4, 1]

    def integral(lo, hi, g):
        return (hi - lo) / 600 * sum(w * g(lo + (hi - lo) * k / 200) for k, w in enumerate(weights))

    def line(alpha):
        s, c = math.sin(alpha) * math.cos(b1), math.cos(alpha) * math.cos(b1)
        e = math.sqrt(max(0.0, c * c + math.cos(b2) ** 2 - math.cos(b1) ** 2))
        o1, o2 = math.atan2(math.sin(b1), c), math.atan2(math.sin(b2), e)
        w = math.atan2(s * math.sin(b2), e) - math.atan2(s * math.sin(b1), c)
        k2 = (a * a / b / b - 1) * (1 - s * s)
        slow = integral(o1, o2, lambda x: (2 - f) / (1 + (1 - f) * math.sqrt(1 + k2 * math.sin(x) ** 2)))
        return w - f * s * slow, b * integral(o1, o2, lambda x: math.sqrt(1 + k2 * math.sin(x) ** 2))

    lo, hi = 0.0, math.pi
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if line(mid)[0] < lon else (lo, mid)
    return line((lo + hi) / 2)[1] / 1000


def test_geodesic_search_settles_hard_pairs(spark):
    """Flat and steep longitudes: a few interpolations where the plain halving needs 56 steps."""
    pts = [(lat, 3.0, off - lat, 183.0 - near) for lat in (1e-7, 0.3, 30.0, 60.0, 89.2) for off in (-0.7, 1e-9, 0.4)
           for near in (0.0, 1e-9, 0.3, 0.6, 1.5)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double").repartition(4)
    got = {tuple(r)[:4]: r.km for r in with_geodesic_km(df, "a", "b", "c", "d", "km").collect()}
    assert len(got) == len(pts)
    assert max(abs(got[p] - _halved_reference(*p)) for p in pts if p[0] > 1e-6) < 1e-8
    # a hair off the equator no double holds the azimuth well enough, yet the length is the equator's
    assert abs(got[(1e-7, 3.0, 1e-9 - 1e-7, 181.5)] - 6378.137 * math.radians(178.5)) < 1e-8


def test_antipodal_rows_are_dealt_to_all_tasks(spark, tmp_path):
    """One row group of customers must not leave all the solving to one task."""
    from pyspark.sql import functions as F

    from blotter.catalog import QUERIES

    spark.range(2000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    out = QUERIES["geodesic_antipodal"](spark, str(tmp_path))
    parts = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 2000 and len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_geodesic_keeps_other_columns_and_stays_native(spark):
    df = spark.createDataFrame([(1, "x y", 34.0, -118.0, 34.1, -118.1)], "id int, `AREA NAME` string, a double, b double, c double, d double")
    out = with_geodesic_km(df, "a", "b", "c", "d", "dist")
    assert out.columns == ["id", "AREA NAME", "a", "b", "c", "d", "dist"]
    from blotter.plans import physical_section
    plan = physical_section(out)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
