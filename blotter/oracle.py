"""Independent DuckDB SQL for each key of ``blotter.catalog.QUERIES``.

The tables ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are views over
the same Parquet files.  Column names and types match the Spark results:
Spark's ``year``/``month``/``row_number`` are INT, DuckDB's BIGINT, so the
SQL casts; numeric literals are forced to DOUBLE, since DuckDB reads ``0.6``
as DECIMAL.
"""

from __future__ import annotations

import numpy as np

# Fixed values, written out here so that a wrong one in the library shows.
ORDER_STATUS_TEXT = [("F", "Fulfilled"), ("O", "Open"), ("P", "Partial")]
RETURN_FLAG_TEXT = [("A", "Accepted"), ("N", "Not returned"), ("R", "Returned"), ("X", "Unknown")]
EARLY = "coalesce(o_orderdate < TIMESTAMP '1998-01-01 00:00:00', FALSE)"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
STEPS = 12  # the made-up stations lie within 200 km: converged to the last bits well before


def _d(x: float) -> str:
    """A double literal that DuckDB reads back bit for bit."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def _values(rows: list[tuple[str, str]], alias: str, cols: tuple[str, str]) -> str:
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {alias}({cols[0]}, {cols[1]})"


def _day_segment_case(t: str) -> str:
    return (
        f"CASE WHEN {t} IS NULL THEN NULL "
        f"WHEN {t} >= 500 AND {t} < 1200 THEN 'morning' "
        f"WHEN {t} >= 1200 AND {t} < 1700 THEN 'afternoon' "
        f"WHEN {t} >= 1700 AND {t} < 2100 THEN 'evening' "
        f"ELSE 'night' END"
    )


def _code_text(c: str) -> str:
    return f"CAST(CAST(floor({c}) AS BIGINT) AS VARCHAR)"


def _cust_lat(k: str) -> str:
    return f"({_d(33.7)} + (({k} * 7919) % 10007) / {_d(10007.0)} * {_d(0.6)})"


def _cust_lon(k: str) -> str:
    return f"({_d(-118.7)} + (({k} * 104729) % 10009) / {_d(10009.0)} * {_d(0.6)})"


def _station_lat(k: str) -> str:
    return f"({_d(33.7)} + {k} * {_d(0.025)})"


def _station_lon(k: str) -> str:
    return f"({_d(-118.7)} + (({k} * 7) % 25) * {_d(0.025)})"


def _vincenty_ctes(source: str, keep: str, lat1: str, lon1: str, lat2: str, lon2: str, prefix: str) -> tuple[list[str], str]:
    """CTE chain computing ``dist_km`` from ``source``; returns (ctes, last name).

    Every step is MATERIALIZED: inlined, the repeated column references would
    make DuckDB's merged expressions grow exponentially with the iterations.
    """
    f = WGS84_F
    ctes = []
    name = f"{prefix}0"
    ctes.append(
        f"{name} AS MATERIALIZED (SELECT {keep}, radians({lon2} - {lon1}) AS L, "
        f"atan({_d(1 - f)} * tan(radians({lat1}))) AS U1, "
        f"atan({_d(1 - f)} * tan(radians({lat2}))) AS U2 FROM {source})"
    )
    prev, name = name, f"{prefix}1"
    ctes.append(
        f"{name} AS MATERIALIZED (SELECT {keep}, L, sin(U1) AS sU1, cos(U1) AS cU1, sin(U2) AS sU2, cos(U2) AS cU2, "
        f"L AS lam FROM {prev})"
    )
    base = f"{keep}, L, sU1, cU1, sU2, cU2"
    for i in range(STEPS):
        prev, name = name, f"{prefix}i{i}a"
        ctes.append(
            f"{name} AS MATERIALIZED (SELECT {base}, lam, "
            f"sqrt((cU2 * sin(lam)) * (cU2 * sin(lam)) + (cU1 * sU2 - sU1 * cU2 * cos(lam)) * (cU1 * sU2 - sU1 * cU2 * cos(lam))) AS ss, "
            f"sU1 * sU2 + cU1 * cU2 * cos(lam) AS cs, sin(lam) AS sl FROM {prev})"
        )
        prev, name = name, f"{prefix}i{i}b"
        ctes.append(
            f"{name} AS MATERIALIZED (SELECT {base}, lam, ss, cs, atan2(ss, cs) AS sig, "
            f"CASE WHEN ss = 0 THEN {_d(0.0)} ELSE cU1 * cU2 * sl / ss END AS sa FROM {prev})"
        )
        prev, name = name, f"{prefix}i{i}c"
        ctes.append(
            f"{name} AS MATERIALIZED (SELECT {base}, ss, cs, sig, sa, {_d(1.0)} - sa * sa AS c2a FROM {prev})"
        )
        prev, name = name, f"{prefix}i{i}d"
        ctes.append(
            f"{name} AS MATERIALIZED (SELECT {base}, ss, cs, sig, sa, c2a, "
            f"CASE WHEN c2a = 0 THEN {_d(0.0)} ELSE cs - {_d(2.0)} * sU1 * sU2 / c2a END AS c2sm, "
            f"{_d(f / 16)} * c2a * ({_d(4.0)} + {_d(f)} * ({_d(4.0)} - {_d(3.0)} * c2a)) AS C FROM {prev})"
        )
        prev, name = name, f"{prefix}i{i}e"
        ctes.append(
            f"{name} AS MATERIALIZED (SELECT {base}, ss, cs, sig, c2a, c2sm, "
            f"L + ({_d(1.0)} - C) * {_d(f)} * sa * (sig + C * ss * (c2sm + C * cs * ({_d(-1.0)} + {_d(2.0)} * c2sm * c2sm))) AS lam "
            f"FROM {prev})"
        )
    ratio = (WGS84_A**2 - WGS84_B**2) / WGS84_B**2
    prev, name = name, f"{prefix}u"
    ctes.append(f"{name} AS MATERIALIZED (SELECT {keep}, ss, cs, sig, c2sm, c2a * {_d(ratio)} AS u2 FROM {prev})")
    prev, name = name, f"{prefix}ab"
    ctes.append(
        f"{name} AS MATERIALIZED (SELECT {keep}, ss, cs, sig, c2sm, "
        f"{_d(1.0)} + u2 / 16384 * ({_d(4096.0)} + u2 * ({_d(-768.0)} + u2 * ({_d(320.0)} - {_d(175.0)} * u2))) AS A, "
        f"u2 / 1024 * ({_d(256.0)} + u2 * ({_d(-128.0)} + u2 * ({_d(74.0)} - {_d(47.0)} * u2))) AS B FROM {prev})"
    )
    prev, name = name, f"{prefix}km"
    delta = (
        f"B * ss * (c2sm + B / 4 * (cs * ({_d(-1.0)} + {_d(2.0)} * c2sm * c2sm) "
        f"- B / 6 * c2sm * ({_d(-3.0)} + {_d(4.0)} * ss * ss) * ({_d(-3.0)} + {_d(4.0)} * c2sm * c2sm)))"
    )
    ctes.append(f"{name} AS MATERIALIZED (SELECT {keep}, {_d(WGS84_B / 1000.0)} * A * (sig - {delta}) AS dist_km FROM {prev})")
    return ctes, name


def _customer_station_ctes(where: str = "TRUE") -> str:
    return f"""
    facts AS (
        SELECT c_custkey, c_nationkey AS area, {_cust_lat('c_custkey')} AS lat1, {_cust_lon('c_custkey')} AS lon1
        FROM customer WHERE {where}
    ),
    posts AS (
        SELECT n_nationkey AS area, n_name AS division,
               {_station_lat('n_nationkey')} AS lat2, {_station_lon('n_nationkey')} AS lon2
        FROM nation
    ),
    pairs AS (SELECT c_custkey, division, lat1, lon1, lat2, lon2 FROM facts JOIN posts USING (area))"""


def _geodesic_sql() -> str:
    ctes, last = _vincenty_ctes("pairs", "c_custkey", "lat1", "lon1", "lat2", "lon2", "g")
    return (
        "WITH " + _customer_station_ctes() + ",\n    " + ",\n    ".join(ctes)
        + f"\nSELECT c_custkey, round(dist_km, 6) AS distance_km FROM {last}"
    )


def antipodal_sql(digits: int = 5) -> str:
    """Halving of the azimuth in a recursive query, integrals by 20 Gauss-Legendre terms."""
    f, one = _d(WGS84_F), _d(1.0)
    at, weight = np.polynomial.legendre.leggauss(20)
    nodes = ", ".join(f"{{'x': {_d(x)}, 'w': {_d(w)}}}" for x, w in zip(at, weight))

    def integral(term: str) -> str:
        x = "sin((o2 + o1) / 2 + (o2 - o1) / 2 * g.x)"
        return f"(o2 - o1) / 2 * list_sum(list_transform(nodes, lambda g: g.w * ({term.format(x=x)})))"

    return f"""
WITH RECURSIVE points AS (
    SELECT c_custkey, c_custkey % 10 = 0 AS equator,
           CASE WHEN equator THEN {_d(0.0)} ELSE CAST(c_custkey * 7919 % 18001 AS DOUBLE) / {_d(100.0)} - {_d(90.0)} END AS lat1,
           CASE WHEN equator THEN {_d(0.0)} ELSE CAST(c_custkey * 31 % 101 - 50 AS DOUBLE) / {_d(50.0)} END - lat1 AS free2,
           greatest({_d(-90.0)}, least({_d(90.0)}, free2)) AS lat2,
           radians(abs({_d(180.0)} - CAST(c_custkey * 17 % 151 AS DOUBLE) / {_d(100.0)})) AS lon
    FROM customer
), reduced AS (
    SELECT c_custkey, lon, abs(lat1) >= abs(lat2) AS far1,
           CASE WHEN far1 THEN lat1 ELSE lat2 END AS far, CASE WHEN far1 THEN lat2 ELSE lat1 END AS close,
           atan((1 - {f}) * tan(radians(-abs(far)))) AS b1,
           atan((1 - {f}) * tan(radians(CASE WHEN far > 0 THEN -close ELSE close END))) AS b2
    FROM points
), tried(c_custkey, lon, b1, b2, lo, hi, n) AS (
    SELECT c_custkey, lon, b1, b2, {_d(0.0)}, pi(), 0 FROM reduced
    UNION ALL
    SELECT c_custkey, lon, b1, b2, CASE WHEN passed < lon THEN mid ELSE lo END, CASE WHEN passed < lon THEN hi ELSE mid END, n + 1
    FROM (
        SELECT *, w - {f} * s * {integral(f"(2 - {f}) / (1 + (1 - {f}) * sqrt(1 + k2 * {{x}} * {{x}}))")} AS passed
        FROM ({_line_sql('tried', '(lo + hi) / 2', nodes, 'lo, hi, n')} WHERE n < 60)
    )
), lines AS (
    {_line_sql('tried', '(lo + hi) / 2', nodes, 'n')} WHERE n = 60
)
SELECT c_custkey,
       round(CASE WHEN b1 = 0 AND b2 = 0 AND lon <= (1 - {f}) * pi() THEN {_d(WGS84_A)} * lon
                  ELSE {_d(WGS84_B)} * {integral(f"sqrt({one} + k2 * {{x}} * {{x}})")} END / 1000, {digits}) AS distance_km
FROM lines
"""


def _line_sql(source: str, azimuth: str, nodes: str, keep: str) -> str:
    """The line leaving latitude ``b1`` at an azimuth, where it meets latitude ``b2``: arcs, longitude, k2."""
    turned = "CASE WHEN b1 = 0 AND c < 0 THEN -pi() ELSE"
    return f"""SELECT c_custkey, lon, b1, b2, {keep}, {azimuth} AS mid, [{nodes}] AS nodes,
               sin(mid) * cos(b1) AS s, cos(mid) * cos(b1) AS c,
               sqrt(greatest({_d(0.0)}, c * c + CASE WHEN cos(b1) < -sin(b1)
                   THEN (cos(b2) - cos(b1)) * (cos(b2) + cos(b1)) ELSE (sin(b1) - sin(b2)) * (sin(b1) + sin(b2)) END)) AS e,
               {turned} atan2(sin(b1), c) END AS o1, atan2(sin(b2), e) AS o2,
               atan2(s * sin(b2), e) - ({turned} atan2(s * sin(b1), c) END) AS w,
               {_d(WGS84_A**2 / WGS84_B**2 - 1)} * (1 - s * s) AS k2
        FROM {source}"""


def _q4_sql() -> str:
    lo, hi = 1000, 2000
    where = (
        f"c_mktsegment <> 'Null Island' AND CAST(floor(c_acctbal) AS BIGINT) >= {lo} "
        f"AND CAST(floor(c_acctbal) AS BIGINT) < {hi}"
    )
    ctes, last = _vincenty_ctes("pairs", "division", "lat1", "lon1", "lat2", "lon2", "g")
    return (
        "WITH " + _customer_station_ctes(where) + ",\n    " + ",\n    ".join(ctes)
        + f"""
SELECT division, round(avg(dist_km), 6) AS average_distance, COUNT(*) AS "incidents total"
FROM {last} GROUP BY division"""
    )


def _q3_sql(highest: bool) -> str:
    order = "income DESC, zip ASC" if highest else "income ASC, zip DESC"
    codes = _values(RETURN_FLAG_TEXT, "codes", ("code", "txt"))
    return f"""
WITH inc AS (
    SELECT s.s_suppkey AS zip, CAST(floor(s.s_acctbal) AS BIGINT) AS income
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE contains(r.r_name, 'A')
), chosen_zip AS (
    SELECT zip FROM inc ORDER BY {order} LIMIT 3
), places AS (
    SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS lat, CAST(l_suppkey AS VARCHAR) AS lon, l_suppkey AS zip
    FROM lineitem
), chosen AS (
    SELECT lat, lon FROM places WHERE zip IN (SELECT zip FROM chosen_zip)
), victims AS (
    SELECT CAST(l_partkey AS VARCHAR) AS lat, CAST(l_suppkey AS VARCHAR) AS lon, l_returnflag AS d
    FROM lineitem WHERE l_returnflag IS NOT NULL
), counted AS (
    SELECT d, COUNT(*) AS n FROM victims JOIN chosen USING (lat, lon) GROUP BY d
)
SELECT codes.txt AS "victim descent", counted.n AS "total victims"
FROM counted JOIN {codes} ON counted.d = codes.code
"""


def _q1_sql(ranker: str, tie: str) -> str:
    return f"""
WITH counts AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           COUNT(*) AS crime_total
    FROM orders GROUP BY 1, 2
), ranked AS (
    SELECT year, month, crime_total,
           CAST({ranker}() OVER (PARTITION BY year ORDER BY crime_total DESC{tie}) AS INTEGER) AS "rank"
    FROM counts
)
SELECT year, month, crime_total, "rank" FROM ranked WHERE "rank" <= 3
"""


_Q3_BOTH = (
    f"SELECT 'highest' AS tag, * FROM ({_q3_sql(True)}) "
    f"UNION ALL SELECT 'lowest' AS tag, * FROM ({_q3_sql(False)})"
)

_Q2 = f"""
SELECT {_day_segment_case('h')} AS day_seg, CAST(COUNT(*) AS BIGINT) AS count
FROM (SELECT CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS h FROM events WHERE event_type = 'purchase')
GROUP BY 1
"""

_DAY_SEGMENT = f"""
SELECT event_id, h AS hhmm, {_day_segment_case('h')} AS day_seg
FROM (SELECT event_id, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS h FROM events)
"""

_JOIN_ORDERS_CUSTOMER = """
SELECT o.o_orderkey, o.o_custkey AS custkey, c.c_name, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

_JOIN_LINEITEM_SUPPLIER = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey AS suppkey, s.s_name
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

_AVG_COUNT = """
SELECT event_type, round(avg(value), 6) AS avg_value, COUNT(*) AS n FROM events GROUP BY event_type
"""

_STATUS_NULLS = "(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)"

_CUSTOMER_CODES = f"(SELECT c_custkey, {_code_text('c_acctbal')} AS code FROM customer)"

_DATE_FORMAT = "%m/%d/%Y %I:%M:%S %p"

ORACLE_SQL: dict[str, str] = {
    "q1_df": _q1_sql("ROW_NUMBER", ", month ASC"),
    "q1_sql": _q1_sql("ROW_NUMBER", ", month ASC"),
    "q1_rank_ties": _q1_sql("RANK", ""),
    "q1_two_files": _q1_sql("ROW_NUMBER", ", month ASC"),
    "q1_csv": _q1_sql("ROW_NUMBER", ", month ASC"),
    "q2_day_segments": _Q2,
    "q2_pairs": _Q2,
    "q2_csv": _Q2,
    "q3_top": _q3_sql(True),
    "q3_bottom": _q3_sql(False),
    "q3_top_broadcast": _q3_sql(True),
    "q3_top_shuffle_hash": _q3_sql(True),
    "q3_top_merge": _q3_sql(True),
    "q3_top_merge_all": _q3_sql(True),
    "q3_top_mixed": _q3_sql(True),
    "q3_bottom_mixed": _q3_sql(False),
    "q3_both": _Q3_BOTH,
    "q3_dedupe_first": _Q3_BOTH,
    "q4_mean_distance": _q4_sql(),
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_csv": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, o_orderpriority
        FROM orders""",
    "scan_csv_quoted": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ', "' || c_mktsegment || '"' AS quoted_name
        FROM customer""",
    "scan_csv_aligned": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, o_orderpriority
        FROM orders WHERE o_orderkey % 83 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 97 <> 0""",
    "scan_csv_rejects": f"""
        SELECT CASE WHEN {EARLY} THEN 'early' ELSE 'late' END AS folder,
               CASE WHEN o_orderkey % 83 = 0 THEN 'open quote' WHEN o_orderkey % 89 = 0 THEN 'too many fields'
                    ELSE 'too few fields' END AS reason,
               COUNT(*) AS n_lines
        FROM orders WHERE o_orderkey % 83 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 97 = 0
        GROUP BY 1, 2""",
    "convert_clustered": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS customer,
               strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p') AS o_orderdate, CAST(1996 AS INTEGER) AS year
        FROM orders WHERE year(o_orderdate) = 1996 AND o_custkey >= 100 AND o_custkey < 400""",
    "convert_parquet": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part",
    "sink_csv": "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events",
    "sink_csv_awkward": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE event_id % 5 WHEN 0 THEN '  ' || event_type || ' '
                                 WHEN 1 THEN 'say "' || event_type || '", \\'
                                 WHEN 2 THEN '' WHEN 3 THEN event_type END AS text
        FROM events""",
    "table_count": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "inline_dimension": f"""
        SELECT o.o_orderkey, o.o_orderstatus, s.status_text
        FROM orders o JOIN {_values(ORDER_STATUS_TEXT, 's', ('code', 'status_text'))} ON o.o_orderstatus = s.code""",
    "derive_columns": """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice * (CAST(1.0 AS DOUBLE) - l_discount), 4) AS net_price,
               CAST(year(l_shipdate) AS INTEGER) AS ship_year
        FROM lineitem""",
    "rename_headers": "SELECT o_orderkey AS order_id, o_custkey FROM orders",
    "project_columns": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "distinct_values": "SELECT DISTINCT c_mktsegment FROM customer",
    "union_positional": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE {EARLY}
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE NOT {EARLY}""",
    "union_by_name": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE {EARLY}
        UNION ALL BY NAME
        SELECT o_orderdate, o_orderstatus, o_custkey, o_orderkey FROM orders WHERE NOT {EARLY}""",
    "filter_equal": "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
    "filter_not_equal_null": f"SELECT o_orderkey, status FROM {_STATUS_NULLS} WHERE status <> 'F'",
    "filter_not_null": f"SELECT o_orderkey, status FROM {_STATUS_NULLS} WHERE status IS NOT NULL",
    "filter_contains": "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')",
    "filter_regex": f"SELECT c_custkey, code FROM {_CUSTOMER_CODES} WHERE regexp_matches(code, '1..')",
    "filter_range": f"""
        SELECT c_custkey, CAST(code AS INTEGER) AS code FROM {_CUSTOMER_CODES}
        WHERE CAST(code AS INTEGER) >= 100 AND CAST(code AS INTEGER) < 200""",
    "filter_range_native": "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey >= 100 AND c_custkey < 200",
    "join_inner": """
        SELECT c.c_custkey, c.c_nationkey AS nationkey, n.n_name
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "join_composite": """
        SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_partkey AS VARCHAR) AS "LAT",
               CAST(l.l_suppkey AS VARCHAR) AS "LON", p.zip
        FROM lineitem l
        JOIN (SELECT DISTINCT l_partkey, l_suppkey, l_suppkey AS zip FROM lineitem) p
          ON CAST(l.l_partkey AS VARCHAR) = CAST(p.l_partkey AS VARCHAR)
         AND CAST(l.l_suppkey AS VARCHAR) = CAST(p.l_suppkey AS VARCHAR)""",
    "join_broadcast": _JOIN_ORDERS_CUSTOMER,
    "join_shuffle_hash": _JOIN_ORDERS_CUSTOMER,
    "join_merge": _JOIN_ORDERS_CUSTOMER,
    "join_hash_bounded": _JOIN_ORDERS_CUSTOMER,
    "join_hot_key": """
        SELECT l.l_orderkey, l.l_linenumber, s.s_suppkey AS suppkey, s.s_name
        FROM lineitem l JOIN supplier s
          ON s.s_suppkey = CASE WHEN l.l_orderkey % 3 = 0 THEN 1 ELSE l.l_suppkey END""",
    "join_map_side": _JOIN_LINEITEM_SUPPLIER,
    "join_repartition": _JOIN_LINEITEM_SUPPLIER,
    "join_normalised_key": """
        SELECT c.c_custkey, c.c_nationkey AS area, n.n_name AS division
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "count_by_group": """
        SELECT o_orderstatus, o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1, 2""",
    "avg_and_count": _AVG_COUNT,
    "mean_from_sum_count": _AVG_COUNT,
    "mean_exact": """
        SELECT event_type, round(fsum(value) / count(value), 9) AS avg_value, COUNT(*) AS n,
               round(fsum(value), 6) AS sum_value
        FROM events GROUP BY event_type""",
    "agg_dict": """
        SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS sum_linenumber FROM lineitem GROUP BY 1""",
    "dedupe_any": "SELECT DISTINCT lang || ' ' || source AS key FROM documents",
    "dedupe_first": """
        SELECT key, doc_id, n_chars FROM (
            SELECT lang || ' ' || source AS key, doc_id, n_chars,
                   ROW_NUMBER() OVER (PARTITION BY lang || ' ' || source ORDER BY doc_id) AS rn
            FROM documents)
        WHERE rn = 1""",
    "sort_mixed": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               COUNT(*) AS n
        FROM orders GROUP BY 1, 2 ORDER BY year ASC, n DESC, month ASC""",
    "topk_bottomk": """
        SELECT * FROM (SELECT 'top' AS tag, s_suppkey, CAST(floor(s_acctbal) AS INTEGER) AS income
                       FROM supplier ORDER BY income DESC, s_suppkey ASC LIMIT 3)
        UNION ALL
        SELECT * FROM (SELECT 'bottom' AS tag, s_suppkey, CAST(floor(s_acctbal) AS INTEGER) AS income
                       FROM supplier ORDER BY income ASC, s_suppkey DESC LIMIT 3)""",
    "parse_timestamp": f"""
        SELECT o_orderkey, date_text, try_strptime(date_text, '{_DATE_FORMAT}') AS parsed FROM (
            SELECT o_orderkey,
                   CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE strftime(o_orderdate, '{_DATE_FORMAT}') END
                       AS date_text
            FROM orders)""",
    "parse_hhmm": """
        SELECT event_id, strftime(ts, '%H%M') AS hhmm_text,
               strptime('1970-01-01 ' || strftime(ts, '%H%M'), '%Y-%m-%d %H%M') AS time_of_day
        FROM events""",
    "reject_ledger": """
        WITH counts AS (
            SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS year,
                   CASE WHEN o_orderstatus = 'P' THEN NULL ELSE month(o_orderdate) END AS month, COUNT(*) AS n
            FROM orders GROUP BY 1, 2
        ), ranked AS (
            SELECT year, n, row_number() OVER (PARTITION BY year ORDER BY n DESC, month) AS place FROM counts
        )
        SELECT 'rows' AS cause, COUNT(*) AS n FROM orders
        UNION ALL SELECT 'date', COUNT(*) FILTER (o_orderstatus = 'P' AND o_orderstatus IS NOT NULL) FROM orders
        UNION ALL SELECT 'code', COUNT(*) FILTER (o_custkey % 7 = 0) FROM orders
        UNION ALL SELECT 'income', COUNT(*) FILTER (o_orderkey % 11 = 0) FROM orders
        UNION ALL SELECT coalesce(CAST(year AS VARCHAR), 'no year') || '-' || CAST(place AS VARCHAR), n
        FROM ranked WHERE place <= 3""",
    "year_month": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders""",
    "cast_int": """
        SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS area_text,
               CAST(c_nationkey AS INTEGER) AS area, TRY_CAST(c_mktsegment AS INTEGER) AS segment_number
        FROM customer""",
    "default_int": f"""
        SELECT c_custkey,
               CASE WHEN c_acctbal < 0 THEN '' ELSE {_code_text('c_acctbal')} END AS code_text,
               CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(floor(c_acctbal) AS INTEGER) END AS code
        FROM customer""",
    "day_segment": _DAY_SEGMENT,
    "day_segment_udf": _DAY_SEGMENT,
    "currency_to_int": """
        SELECT o_orderkey, '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS income_text,
               CAST(floor(o_totalprice) AS INTEGER) AS income
        FROM orders""",
    "concat_key": """
        SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR) AS latlon
        FROM lineitem""",
    "split_replace": """
        SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, replace(p_name, ' ', '_') AS underscored
        FROM part""",
    "decode_codes": f"""
        SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, f.flag_text
        FROM lineitem l LEFT JOIN {_values(RETURN_FLAG_TEXT, 'f', ('code', 'flag_text'))} ON l.l_returnflag = f.code""",
    "geodesic_km": _geodesic_sql(),
    "geodesic_antipodal": antipodal_sql(),
}
