"""Named queries over the driver's TPC-H-like tables.

Each entry maps the incident-data operators onto those tables (which table
stands in for which incident file is noted per group) and returns a lazy
DataFrame.  Every query reads whole tables; none caps or samples rows.
``blotter.oracle`` holds an independent DuckDB SQL text per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.daypart import day_segment, day_segment_pandas
from blotter.functions.geodesy import with_geodesic_km
from blotter.functions.numeric import currency_text, currency_to_int, int_or_zero, to_int
from blotter.functions.text import join_key, replace_text, token
from blotter.functions.time import (
    format_timestamp,
    hhmm_number,
    hhmm_text,
    parse_hhmm,
    parse_timestamp,
    year_of,
    month_of,
)
from blotter.operators import aggregates as agg
from blotter.operators import exact
from blotter.operators import filters as flt
from blotter.operators import joins
from blotter.operators import ordering
from blotter.operators import projections as proj
from blotter.operators import skew
from blotter.operators.setops import union_by_name, union_positional
from blotter.questions import (
    day_segment_counts,
    descent_breakdown,
    peak_months,
    peak_months_sql,
    station_distance,
)
from blotter.session import scratch_path
from blotter.sources.csv import read_csv, read_csv_checked, write_csv
from blotter.sources.inline import inline_table
from blotter.plans.guards import materialise
from blotter.plans.ledger import RejectLedger
from blotter.sources.parquet import csv_to_parquet, read_parquet, read_table

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the analogs.
ORDER_STATUS_TEXT = [("F", "Fulfilled"), ("O", "Open"), ("P", "Partial")]
RETURN_FLAG_TEXT = [("A", "Accepted"), ("N", "Not returned"), ("R", "Returned"), ("X", "Unknown")]
SPLIT_DATE = "1998-01-01 00:00:00"
FIREARM_LIKE_CODES = (1000, 2000)


# ------------------------------------------------------------- shared analogs


def _code_text(c: Column) -> Column:
    """Whole part of a money amount as text: the 'weapon code' of a customer."""
    return F.floor(c).cast("bigint").cast("string")


def _customer_coordinates(custkey: Column) -> dict[str, Column]:
    lat = F.lit(33.7) + (custkey * 7919 % 10007) / F.lit(10007.0) * F.lit(0.6)
    lon = F.lit(-118.7) + (custkey * 104729 % 10009) / F.lit(10009.0) * F.lit(0.6)
    return {"LAT": lat, "LON": lon}


def customers_as_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → incident rows: zero-padded area, area name, code text, coordinates."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("AREA"),
        F.col("c_mktsegment").alias("AREA NAME"),
        _code_text(F.col("c_acctbal")).alias("Weapon Used Cd"),
        *[v.alias(k) for k, v in _customer_coordinates(F.col("c_custkey")).items()],
    )


def nations_as_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation → one made-up station per nation: X = longitude, Y = latitude."""
    n = read_table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(
        (F.lit(-118.7) + (key * 7 % 25) * F.lit(0.025)).alias("X"),
        (F.lit(33.7) + key * F.lit(0.025)).alias("Y"),
        key.alias("FID"),
        F.col("n_name").alias("DIVISION"),
        key.cast("string").alias("PREC"),
    )


def suppliers_as_incomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier ⋈ nation ⋈ region → Zip Code, Community, Estimated Median Income text."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    return s.join(geo, s.s_nationkey == geo.n_nationkey).select(
        F.col("s_suppkey").alias("Zip Code"),
        F.col("r_name").alias("Community"),
        currency_text(F.floor("s_acctbal")).alias("Estimated Median Income"),
    )


def lineitem_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, supplier) pairs as text coordinates, the supplier as zip code."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("LAT"),
        F.col("l_suppkey").cast("string").alias("LON"),
        F.col("l_suppkey").alias("Zip Code"),
    )


def lineitem_victims(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("LAT"),
        F.col("l_suppkey").cast("string").alias("LON"),
        F.col("l_returnflag").alias("Vict Descent"),
    )


def return_flag_codes(spark: SparkSession) -> DataFrame:
    return inline_table(spark, RETURN_FLAG_TEXT, ["Vict Descent", "Vict Descent text"])


# ---------------------------------------------------------------- questions


def q1_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peak_months(read_table(spark, sf_dir, "orders"), date_col="o_orderdate", date_format=None)


def q1_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peak_months_sql(spark, read_table(spark, sf_dir, "orders"), date_col="o_orderdate", date_format=None)


def q1_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peak_months(
        read_table(spark, sf_dir, "orders"), date_col="o_orderdate", date_format=None, method="rank"
    )


def _by_date(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders before the split date, and all others (also those without a date)."""
    early = F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ '{SPLIT_DATE}'")
    return df.filter(early), df.filter(~F.coalesce(early, F.lit(False)))


def q1_two_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _by_date(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    return peak_months(early, late, date_col="o_orderdate", date_format=None)


def q1_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over two CSV files with the dates as text."""
    halves = []
    for n, part in enumerate(_by_date(read_table(spark, sf_dir, "orders"))):
        path = scratch_path(spark, f"q1-csv-{n}")
        write_csv(part.select("o_orderkey", format_timestamp("o_orderdate").alias("DATE OCC")), path, header=True)
        halves.append(read_csv(spark, path, ["o_orderkey", "DATE OCC"]))
    return peak_months(*halves)


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select("event_type", "ts")


def q2_day_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_segment_counts(_purchases(spark, sf_dir), hhmm_number("ts"), "event_type", "purchase")


def q2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_segment_counts(
        _purchases(spark, sf_dir), hhmm_number("ts"), "event_type", "purchase", pairs=True
    )


def q2_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 over CSV with the time of day as HHmm text."""
    path = scratch_path(spark, "q2-csv")
    events = read_table(spark, sf_dir, "events")
    write_csv(events.select("event_type", hhmm_text("ts").alias("TIME OCC")), path, header=True)
    facts = read_csv(spark, path, ["event_type", "TIME OCC"])
    return day_segment_counts(facts, to_int("TIME OCC"), "event_type", "purchase")


def q3_both(
    spark: SparkSession,
    sf_dir: str,
    strategy: str | dict[str, str | None] | None = None,
    groups: tuple[str, ...] = ("highest", "lowest"),
    key_determines_zip: bool = True,
) -> DataFrame:
    return descent_breakdown(
        lineitem_victims(spark, sf_dir),
        lineitem_places(spark, sf_dir),
        suppliers_as_incomes(spark, sf_dir),
        return_flag_codes(spark),
        community="A",
        key_determines_zip=key_determines_zip,
        strategy=strategy,
        groups=groups,
    )


# A strategy chosen per join, as a user who knows the sizes would hint them.
MIXED = {"zips": "broadcast", "places": "shuffle_hash", "codes": "broadcast"}
ALL_MERGE = {"zips": "merge", "places": "merge", "codes": "merge"}


def _q3_group(group: str, strategy: str | dict[str, str | None] | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q3_both(spark, sf_dir, strategy, (group,)).drop("tag")

    return run


def q3_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zip per coordinate first, then the join with the chosen zips."""
    return q3_both(spark, sf_dir, key_determines_zip=False)


def q4_mean_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_distance(
        customers_as_incidents(spark, sf_dir),
        nations_as_stations(spark, sf_dir),
        code_range=FIREARM_LIKE_CODES,
        digits=6,
    )


# -------------------------------------------------------- scans and sinks


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet")


def _orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    write_csv(_orders_text(spark, sf_dir), path, header=True)
    return read_csv(spark, path)


def scan_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    quoted = c.select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"')).alias("quoted_name"),
    )
    path = scratch_path(spark, "customer-quoted-csv")
    write_csv(quoted, path, header=True)
    return read_csv(spark, path, ["c_custkey", "quoted_name"])


ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _untidy_order_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """orders → two folders of CSV files: other columns first in one, and here and there a line that is no row."""
    key = F.col("o_orderkey")
    folders = []
    for name, part, order, header in zip(
        ("early", "late"),
        _by_date(read_table(spark, sf_dir, "orders")),
        (ORDER_TEXT, ["o_orderpriority", "o_orderkey", "o_orderstatus", "o_custkey"]),
        ("o_orderkey,o_custkey,o_orderstatus,o_orderpriority", " o_orderpriority ,o_orderkey,o_orderstatus , o_custkey"),
    ):
        quoted = [F.concat(F.lit('"'), F.col(c), F.lit('"')) if c == "o_orderpriority" else F.col(c) for c in order]
        line = F.concat_ws(",", *quoted)
        line = (
            F.when(key % 83 == 0, F.concat(F.lit('"'), F.concat_ws(",", *order)))
            .when(key % 89 == 0, F.concat(line, F.lit(",more")))
            .when(key % 97 == 0, F.concat_ws(",", *quoted[:3]))
            .otherwise(line)
        )

        def headed(batches, header=header):
            import pyarrow as pa

            first = True
            for batch in batches:
                if first and batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema[0].type)], schema=batch.schema)
                    first = False
                yield batch

        folders.append(scratch_path(spark, f"orders-{name}"))
        part.select(line.alias("value")).mapInArrow(headed, "value string").write.text(folders[-1])
    return folders


def scan_csv_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files whose headers differ in order and blanks, without the lines that are no rows."""
    return read_csv_checked(spark, _untidy_order_files(spark, sf_dir), ORDER_TEXT)[0]


def scan_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no rows, counted per folder and reason."""
    _, rejects = read_csv_checked(spark, _untidy_order_files(spark, sf_dir), ORDER_TEXT)
    folder = F.regexp_extract("file", "orders-(early|late)-", 1)
    return agg.count_by(rejects, [folder.alias("folder"), "reason"], "n_lines")


def convert_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    source = scratch_path(spark, "part-csv")
    write_csv(p, source, header=True)
    return csv_to_parquet(spark, source, scratch_path(spark, "part-parquet"))


def clustered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → CSV → Parquet in folders by year, ranges of customers within."""
    o = read_table(spark, sf_dir, "orders")
    source = scratch_path(spark, "orders-dated-csv")
    dated = o.select("o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("customer"), "o_orderdate")
    write_csv(dated.withColumn("o_orderdate", format_timestamp("o_orderdate")), source, header=True)
    return csv_to_parquet(
        spark,
        source,
        scratch_path(spark, "orders-clustered"),
        partition_by={"year": year_of(parse_timestamp("o_orderdate"))},
        sort_by=["customer"],
    )


def convert_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year's orders of a range of customers, read back from the clustered files."""
    stored = clustered_orders(spark, sf_dir)
    wanted = flt.where_in_range(stored, "customer", "000000000100", "000000000400").filter("year = 1996")
    return wanted.select("o_orderkey", "customer", "o_orderdate", "year")


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    path = scratch_path(spark, "events-csv")
    write_csv(e, path, header=False, mode="overwrite")
    return read_csv(spark, path, ["event_id", "event_type"], header=False)


def sink_csv_awkward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, quoted, empty and missing text through the CSV sink and back."""
    e = read_table(spark, sf_dir, "events")
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("  "), "event_type", F.lit(" ")))
        .when(kind == 1, F.concat(F.lit('say "'), "event_type", F.lit('", \\')))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.col("event_type"))
    )
    path = scratch_path(spark, "events-awkward-csv")
    write_csv(e.select("event_id", text.alias("text")), path, header=True)
    return read_csv(spark, path, ["event_id", "text"])


def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        read_table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name in TABLES
    ]
    return union_positional(*counts)


def inline_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    status = inline_table(spark, ORDER_STATUS_TEXT, ["o_orderstatus", "status_text"])
    return o.join(F.broadcast(status), "o_orderstatus").select("o_orderkey", "o_orderstatus", "status_text")


# ------------------------------------------------------------ projections


def derive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    out = proj.derive(
        li,
        {
            "net_price": F.round(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")), 4),
            "ship_year": year_of("l_shipdate"),
        },
    )
    return out.select("l_orderkey", "l_linenumber", "net_price", "ship_year")


def rename_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    raw = o.select(F.col("o_orderkey").alias(" o_orderkey"), F.col("o_custkey").alias("o_custkey "))
    return proj.rename(proj.repair_headers(raw), {"o_orderkey": "order_id"})


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proj.project(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proj.distinct_values(read_table(spark, sf_dir, "customer"), ["c_mktsegment"])


def union_positional_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    early, late = _by_date(read_table(spark, sf_dir, "orders").select(*cols))
    return union_positional(early, late.withColumnRenamed("o_orderstatus", "o_orderstatus "))


def union_by_name_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _by_date(read_table(spark, sf_dir, "orders"))
    return union_by_name(
        early.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"),
        late.select("o_orderdate", "o_orderstatus", "o_custkey", "o_orderkey"),
    )


# ---------------------------------------------------------------- filters


def _status_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))


def filter_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return flt.where_equal(e, "event_type", "purchase").select("event_id", "user_id", "value")


def filter_not_equal_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.where_not_equal(_status_with_nulls(spark, sf_dir), "status", "F")


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.where_not_null(_status_with_nulls(spark, sf_dir), "status")


def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return flt.where_contains(p, "p_name", "ring")


def _customer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", _code_text(F.col("c_acctbal")).alias("code"))


def filter_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.where_regex(_customer_codes(spark, sf_dir), "code", "1..")


def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _customer_codes(spark, sf_dir).withColumn("code", to_int("code"))
    return flt.where_in_range(codes, "code", 100, 200)


def filter_range_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range on a stored number: both bounds reach the Parquet scan."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return flt.where_in_range(c, "c_custkey", 100, 200)


# ------------------------------------------------------------------ joins


def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return c.join(n, ["nationkey"], "inner").select("c_custkey", "nationkey", "n_name")


def join_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").cast("string").alias("LAT"),
        F.col("l_suppkey").cast("string").alias("LON"),
    )
    places = lineitem_places(spark, sf_dir).dropDuplicates(["LAT", "LON"])
    return li.join(places, ["LAT", "LON"], "inner").select(
        "l_orderkey", "l_linenumber", "LAT", "LON", F.col("Zip Code").alias("zip")
    )


def _orders_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice"
    )
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return o, c


def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers grow with the input: beyond the broadcast bound they are shuffled and merged."""
    o, c = _orders_customers(spark, sf_dir)
    return joins.broadcast_join(o, c, "custkey").select("o_orderkey", "custkey", "c_name", "o_totalprice")


def _strategy_join(strategy: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        o, c = _orders_customers(spark, sf_dir)
        return joins.join_with_strategy(o, c, "custkey", strategy).select(
            "o_orderkey", "custkey", "c_name", "o_totalprice"
        )

    run.__name__ = f"join_{strategy}"
    return run


def _lineitem_suppliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("suppkey")
    )
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_name")
    return li, s


def join_map_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, s = _lineitem_suppliers(spark, sf_dir)
    return joins.map_side_join(li, s, "suppkey").select("l_orderkey", "l_linenumber", "suppkey", "s_name")


def join_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, s = _lineitem_suppliers(spark, sf_dir)
    return joins.repartition_join(li, s, "suppkey").select("l_orderkey", "l_linenumber", "suppkey", "s_name")


def join_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all line items under one supplier: its rows are dealt to several tasks."""
    li, s = _lineitem_suppliers(spark, sf_dir)
    third = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("suppkey")).cast("long")
    out = skew.hot_key_join(li.withColumn("suppkey", third), s, "suppkey")
    return out.select("l_orderkey", "l_linenumber", "suppkey", "s_name")


def join_hash_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled hash join, the customers' build partitions measured first."""
    o, c = _orders_customers(spark, sf_dir)
    return skew.bounded_hash_join(o, c, "custkey").select("o_orderkey", "custkey", "c_name", "o_totalprice")


def join_normalised_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = customers_as_incidents(spark, sf_dir).select("c_custkey", "AREA")
    posts = nations_as_stations(spark, sf_dir).select("PREC", "DIVISION")
    out = joins.join_normalised(facts, posts, "AREA", "PREC", "area", "broadcast")
    return out.select("c_custkey", "area", F.col("DIVISION").alias("division"))


# ------------------------------------------------------------- aggregates


def count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return agg.count_by(o, ["o_orderstatus", "o_orderpriority"], "count")


def avg_and_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return agg.avg_and_count(e, ["event_type"], "value", "avg_value", "n", digits=6)


def mean_from_sum_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return agg.mean_from_sum_count(e, ["event_type"], "value", "avg_value", "n", digits=6)


def mean_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and sums that are the same bit for bit however the rows are partitioned."""
    e = read_table(spark, sf_dir, "events")
    means = exact.exact_mean(e, ["event_type"], "value", "avg_value", "n", digits=9)
    sums = exact.exact_sum(e, ["event_type"], "value").select("event_type", F.round("sum", 6).alias("sum_value"))
    return means.join(sums, "event_type")


def agg_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    out = agg.agg_dict(li, ["l_returnflag"], {"l_linenumber": "sum"})
    return out.withColumnRenamed("sum(l_linenumber)", "sum_linenumber")


def _documents_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", "n_chars", join_key("lang", "source").alias("key"))


def dedupe_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.dedupe_any(_documents_keyed(spark, sf_dir), ["key"]).select("key")


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.dedupe_first(_documents_keyed(spark, sf_dir), ["key"], "doc_id")


# --------------------------------------------------------------- ordering


def sort_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    counts = agg.count_by(
        o.select(year_of("o_orderdate").alias("year"), month_of("o_orderdate").alias("month")),
        ["year", "month"],
        "n",
    )
    return ordering.sort_by(counts, [F.col("year").asc(), F.col("n").desc(), F.col("month").asc()])


def topk_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", currency_to_int(currency_text(F.floor("s_acctbal"))).alias("income")
    )
    top = ordering.top_k(s, "income", 3, tie="s_suppkey").select(F.lit("top").alias("tag"), "s_suppkey", "income")
    bottom = ordering.bottom_k(s, "income", 3, tie="s_suppkey").select(
        F.lit("bottom").alias("tag"), "s_suppkey", "income"
    )
    return top.unionByName(bottom)


# ---------------------------------------------------------------- scalars


def parse_timestamp_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(format_timestamp("o_orderdate"))
    return o.select("o_orderkey", text.alias("date_text")).withColumn("parsed", parse_timestamp("date_text"))


def parse_hhmm_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", hhmm_text("ts").alias("hhmm_text"))
    return e.withColumn("time_of_day", parse_hhmm("hhmm_text"))


def reject_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over dates as text, with the dates, codes and incomes that could not be read, counted by the job of the answer."""
    o = read_table(spark, sf_dir, "orders")
    partial = F.col("o_orderstatus") == "P"
    raw = o.select(
        F.when(partial, F.lit("not a date")).otherwise(format_timestamp("o_orderdate")).alias("DATE OCC"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("code"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("$ unknown"))
        .otherwise(currency_text(F.floor("o_totalprice")))
        .alias("income"),
    )
    ledger = RejectLedger()
    watched = ledger.watch(
        raw,
        {
            "date": (F.col("DATE OCC"), parse_timestamp("DATE OCC")),
            "code": (F.col("code"), to_int("code")),
            "income": (F.col("income"), currency_to_int("income")),
        },
    )
    answer, _, _ = materialise(peak_months(watched), "q1-answer")
    lost = [(cause, n) for cause, n in ledger.counts().items()]
    counts = spark.createDataFrame(lost, "cause string, n long")
    told = answer.select(
        F.concat_ws("-", F.coalesce(F.col("year").cast("string"), F.lit("no year")), "rank").alias("cause"),
        F.col("crime_total").alias("n"),
    )
    return counts.union(told)


def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", year_of("o_orderdate").alias("year"), month_of("o_orderdate").alias("month"))


def cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    padded = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    return c.select(
        "c_custkey",
        padded.alias("area_text"),
        to_int(padded).alias("area"),
        to_int("c_mktsegment").alias("segment_number"),
    )


def default_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    text = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(_code_text(F.col("c_acctbal")))
    return c.select("c_custkey", text.alias("code_text")).withColumn("code", int_or_zero("code_text"))


def day_segment_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", hhmm_number("ts").alias("hhmm"))
    return e.withColumn("day_seg", day_segment("hhmm"))


def day_segment_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", hhmm_number("ts").alias("hhmm"))
    return e.withColumn("day_seg", day_segment_pandas("hhmm"))


def currency_to_int_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", currency_text(F.floor("o_totalprice")).alias("income_text")
    )
    return o.withColumn("income", currency_to_int("income_text"))


def concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", join_key("l_partkey", "l_suppkey").alias("latlon"))


def split_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        token("p_name", " ", 1).alias("first_word"),
        replace_text("p_name", " ", "_").alias("underscored"),
    )


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    lookup = F.create_map(*[F.lit(x) for pair in RETURN_FLAG_TEXT for x in pair])
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.try_element_at(lookup, F.col("l_returnflag")).alias("flag_text"),
    )


def geodesic_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = customers_as_incidents(spark, sf_dir).select("c_custkey", "AREA", "LAT", "LON")
    posts = nations_as_stations(spark, sf_dir).select("PREC", "X", "Y")
    joined = joins.join_normalised(facts, posts, "AREA", "PREC", "area", "broadcast")
    measured = with_geodesic_km(joined, "LAT", "LON", "Y", "X", "distance_km")
    return measured.select("c_custkey", F.round("distance_km", 6).alias("distance_km"))


def opposite_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → pairs of points opposite each other on the globe but for a degree or so, some on the equator."""
    k = F.col("c_custkey")
    equator = k % 10 == 0
    lat = F.when(equator, F.lit(0.0)).otherwise((k * 7919 % 18001).cast("double") / F.lit(100.0) - F.lit(90.0))
    off = F.when(equator, F.lit(0.0)).otherwise((k * 31 % 101 - 50).cast("double") / F.lit(50.0))
    lon = (k * 104729 % 36000).cast("double") / F.lit(100.0) - F.lit(180.0)
    near = (k * 17 % 151).cast("double") / F.lit(100.0)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", lat.alias("lat1"), lon.alias("lon1"))
    return c.withColumns(
        {
            "lat2": F.greatest(F.lit(-90.0), F.least(F.lit(90.0), off - F.col("lat1"))),
            "lon2": F.col("lon1") + F.lit(180.0) - near,
        }
    )


def geodesic_antipodal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded to a centimetre: two ways of computing differ by nanometres, which moves a rounded last digit now and then."""
    # Every row is solved by its azimuth, which takes far longer than reading it:
    # the few row groups of a customer file are dealt out to all tasks first.
    points = opposite_points(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    measured = with_geodesic_km(points, "lat1", "lon1", "lat2", "lon2", "distance_km")
    return measured.select("c_custkey", F.round("distance_km", 5).alias("distance_km"))


QUERIES: dict[str, Query] = {
    # questions
    "q1_df": q1_df,
    "q1_sql": q1_sql,
    "q1_rank_ties": q1_rank_ties,
    "q1_two_files": q1_two_files,
    "q1_csv": q1_csv,
    "q2_day_segments": q2_day_segments,
    "q2_pairs": q2_pairs,
    "q2_csv": q2_csv,
    "q3_top": _q3_group("highest"),
    "q3_bottom": _q3_group("lowest"),
    "q3_both": q3_both,
    "q3_dedupe_first": q3_dedupe_first,
    "q3_top_broadcast": _q3_group("highest", "broadcast"),
    "q3_top_shuffle_hash": _q3_group("highest", "shuffle_hash"),
    "q3_top_merge": _q3_group("highest", "merge"),
    "q3_top_merge_all": _q3_group("highest", ALL_MERGE),
    "q3_top_mixed": _q3_group("highest", MIXED),
    "q3_bottom_mixed": _q3_group("lowest", MIXED),
    "q4_mean_distance": q4_mean_distance,
    # scans, sources, sinks
    "scan_parquet": scan_parquet,
    "scan_csv": scan_csv,
    "scan_csv_quoted": scan_csv_quoted,
    "scan_csv_aligned": scan_csv_aligned,
    "scan_csv_rejects": scan_csv_rejects,
    "convert_parquet": convert_parquet,
    "convert_clustered": convert_clustered,
    "sink_csv": sink_csv,
    "sink_csv_awkward": sink_csv_awkward,
    "table_count": table_count,
    "inline_dimension": inline_dimension,
    # projections and unions
    "derive_columns": derive_columns,
    "rename_headers": rename_headers,
    "project_columns": project_columns,
    "distinct_values": distinct_values,
    "union_positional": union_positional_q,
    "union_by_name": union_by_name_q,
    # filters
    "filter_equal": filter_equal,
    "filter_not_equal_null": filter_not_equal_null,
    "filter_not_null": filter_not_null,
    "filter_contains": filter_contains,
    "filter_regex": filter_regex,
    "filter_range": filter_range,
    "filter_range_native": filter_range_native,
    # joins
    "join_inner": join_inner,
    "join_composite": join_composite,
    "join_broadcast": join_broadcast,
    "join_shuffle_hash": _strategy_join("shuffle_hash"),
    "join_merge": _strategy_join("merge"),
    "join_hot_key": join_hot_key,
    "join_hash_bounded": join_hash_bounded,
    "join_map_side": join_map_side,
    "join_repartition": join_repartition,
    "join_normalised_key": join_normalised_key,
    # aggregates
    "count_by_group": count_by_group,
    "avg_and_count": avg_and_count,
    "mean_from_sum_count": mean_from_sum_count,
    "mean_exact": mean_exact,
    "agg_dict": agg_dict,
    "dedupe_any": dedupe_any,
    "dedupe_first": dedupe_first,
    # ordering
    "sort_mixed": sort_mixed,
    "topk_bottomk": topk_bottomk,
    # scalar functions
    "parse_timestamp": parse_timestamp_q,
    "parse_hhmm": parse_hhmm_q,
    "reject_ledger": reject_ledger,
    "year_month": year_month,
    "cast_int": cast_int,
    "default_int": default_int,
    "day_segment": day_segment_q,
    "day_segment_udf": day_segment_udf,
    "currency_to_int": currency_to_int_q,
    "concat_key": concat_key,
    "split_replace": split_replace,
    "decode_codes": decode_codes,
    "geodesic_km": geodesic_km,
    "geodesic_antipodal": geodesic_antipodal,
}
