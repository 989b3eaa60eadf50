"""The four worked questions, as lazy functions over incident-style tables.

Column names are parameters; the defaults are the incident file's headers.

Q1  peak_months            the n months with most incidents per year
Q2  day_segment_counts     incidents at one kind of premises by part of day
Q3  descent_breakdown      victims by descent in the richest / poorest zip codes
Q4  station_distance       per division: incidents in a code range and their
                           mean distance to the responsible station
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from blotter.functions.daypart import day_segment
from blotter.functions.geodesy import with_geodesic_km
from blotter.functions.numeric import currency_to_long, to_int
from blotter.functions.time import REPORT_FORMAT, month_of, parse_timestamp, year_of
from blotter.operators.aggregates import avg_and_count, count_by, sum_ones_by
from blotter.operators.exact import exact_mean
from blotter.operators.filters import where_contains, where_not_equal, where_not_null
from blotter.operators.joins import STRATEGIES, join_normalised, join_with_strategy
from blotter.operators.ordering import bottom_k, sort_result, top_k
from blotter.operators.setops import union_positional
from blotter.operators.windows import top_n_per_group
from blotter.plans.guards import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, materialise

# --------------------------------------------------------------------- Q1


def with_year_month(incidents: DataFrame, date_col: str = "DATE OCC", date_format: str | None = REPORT_FORMAT) -> DataFrame:
    """Add int columns ``year`` and ``month`` of the occurrence date.

    ``date_format`` parses a text column; pass ``None`` for a timestamp column.
    """
    date = F.col(date_col)
    if date_format is not None:
        date = parse_timestamp(date, date_format)
    return incidents.withColumns({"year": year_of(date), "month": month_of(date)})


def peak_months(
    *incidents: DataFrame,
    date_col: str = "DATE OCC",
    date_format: str | None = REPORT_FORMAT,
    n: int = 3,
    method: str = "row_number",
) -> DataFrame:
    """Per year the ``n`` months with most incidents: year, month, crime_total, rank.

    Several inputs (e.g. one file per decade) are unioned by position first.
    ``method='row_number'`` gives positions (ties broken by month);
    ``'rank'`` lets equal counts share a rank.
    """
    facts = with_year_month(union_positional(*incidents), date_col, date_format)
    counts = count_by(facts, ["year", "month"], "crime_total")
    order = [F.col("crime_total").desc()]
    if method == "row_number":
        order.append(F.col("month").asc())  # positions need a deterministic tie break
    top = top_n_per_group(counts, ["year"], order, n, method, "rank")
    return sort_result(top.select("year", "month", "crime_total", "rank"), ["year", "rank", "month"])


PEAK_MONTHS_SQL = """
SELECT * FROM (
    SELECT year, month, count(*) AS crime_total,
           {ranker}() OVER (PARTITION BY year ORDER BY count(*) DESC{tie}) AS rank
    FROM {view}
    GROUP BY year, month
)
WHERE rank <= {n}
ORDER BY year, rank, month
"""


def peak_months_sql(
    spark: SparkSession,
    *incidents: DataFrame,
    date_col: str = "DATE OCC",
    date_format: str | None = REPORT_FORMAT,
    n: int = 3,
    method: str = "row_number",
) -> DataFrame:
    """Q1 written in SQL over the incidents as a view: one SELECT whose window ranks the grouped counts."""
    if method not in ("row_number", "rank"):
        raise ValueError("method must be 'row_number' or 'rank'")
    facts = with_year_month(union_positional(*incidents), date_col, date_format)
    tie = ", month ASC" if method == "row_number" else ""
    query = PEAK_MONTHS_SQL.format(view="{facts}", ranker=method.upper(), tie=tie, n=int(n))
    # The DataFrame argument is bound as a temporary view for this query only.
    return spark.sql(query, facts=facts.select("year", "month"))


# --------------------------------------------------------------------- Q2


def day_segment_counts(
    incidents: DataFrame,
    hhmm: Column,
    premise_col: str = "Premis Desc",
    premise: str | None = "STREET",
    pairs: bool = False,
) -> DataFrame:
    """Incidents at ``premise`` per part of the day, most first: day_seg, count.

    ``hhmm`` is the time of day as the number HHmm.  ``pairs=True`` counts by
    summing a one per row, the key/value formulation of the same question.
    """
    facts = incidents if premise is None else incidents.filter(F.col(premise_col) == premise)
    segments = facts.select(day_segment(hhmm).alias("day_seg"))
    counted = sum_ones_by(segments, ["day_seg"]) if pairs else count_by(segments, ["day_seg"])
    return sort_result(counted, [F.col("count").desc(), F.col("day_seg").asc()])


# --------------------------------------------------------------------- Q3

GROUPS = ("highest", "lowest")
Q3_JOINS = ("zips", "places", "codes")


def _join_strategies(strategy: str | Mapping[str, str | None] | None) -> dict[str, str | None]:
    """One strategy per join of Q3; a single name covers the fact and code joins."""
    if strategy is None or isinstance(strategy, str):
        strategy = {"places": strategy, "codes": strategy if strategy != "broadcast" else None}
    if set(strategy) - set(Q3_JOINS):
        raise ValueError(f"strategies are given for {Q3_JOINS}")
    for name in strategy.values():
        if name is not None and name not in STRATEGIES:
            raise ValueError(f"unknown join strategy {name!r}; use one of {STRATEGIES}")
    return {join: strategy.get(join) for join in Q3_JOINS}


def income_zips(
    incomes: DataFrame,
    k: int = 3,
    zip_col: str = "Zip Code",
    community_col: str = "Community",
    income_col: str = "Estimated Median Income",
    community: str | None = "Los Angeles",
    groups: Sequence[str] = GROUPS,
) -> DataFrame:
    """The k richest (tag ``highest``) and k poorest (``lowest``) zip codes, or one of the two groups.

    Income text such as ``'$61,201'`` is parsed natively.  At most ``2k`` rows,
    so the result is safe to broadcast.
    """
    parsed = incomes.withColumn("__income", currency_to_long(income_col))
    if community is not None:
        parsed = where_contains(parsed, community_col, community)
    parsed = parsed.select(zip_col, "__income")
    if not groups or set(groups) - set(GROUPS):
        raise ValueError(f"groups must be some of {GROUPS}")
    pick = {"highest": top_k, "lowest": bottom_k}
    return union_positional(
        *[pick[g](parsed, "__income", k, tie=zip_col).select(zip_col, F.lit(g).alias("tag")) for g in groups]
    )


def descent_breakdown(
    facts: DataFrame,
    places: DataFrame,
    incomes: DataFrame,
    codes: DataFrame,
    *,
    k: int = 3,
    lat_col: str = "LAT",
    lon_col: str = "LON",
    zip_col: str = "Zip Code",
    descent_col: str = "Vict Descent",
    community_col: str = "Community",
    income_col: str = "Estimated Median Income",
    community: str | None = "Los Angeles",
    code_text_col: str = "Vict Descent text",
    key_determines_zip: bool = False,
    strategy: str | Mapping[str, str | None] | None = None,
    groups: Sequence[str] = GROUPS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Victims by descent in the k richest and k poorest zip codes.

    Result: ``tag`` (highest / lowest), ``victim descent``, ``total victims``,
    most first.  Both groups come from one pass over the facts: the 2k zip
    codes are tagged, the facts are joined once and counted per (tag, code).
    ``groups`` leaves one of them out of all the work.

    ``places`` maps (lat, lon) text to a zip code; one row per (lat, lon) is
    kept.  When the zip code is a function of (lat, lon)
    (``key_determines_zip``), places are restricted to the chosen zips before
    de-duplication, which leaves the result unchanged and shrinks the shuffle
    to the places of 2k zips.  The chosen places are written once to the
    shared scratch folder; when they pass the size check they are broadcast
    and the facts are never shuffled.

    ``strategy`` forces a join strategy: one name for the facts ⋈ places and
    counts ⋈ codes joins, or a mapping with a name per join (``'zips'``:
    places ⋈ chosen zips, ``'places'``, ``'codes'``).  ``'broadcast'`` of
    places or codes raises beyond the size bound.  The chosen zips, at most
    2k rows, are broadcast unless another strategy is given for them.
    """
    chosen_by = _join_strategies(strategy)
    zips = income_zips(incomes, k, zip_col, community_col, income_col, community, groups)
    zips = zips.hint(chosen_by["zips"] or "broadcast")
    keyed = places.select(lat_col, lon_col, zip_col)
    if key_determines_zip:
        # one zip per (lat, lon): tag first, then a plain hash distinct
        chosen = keyed.join(zips, zip_col).select(lat_col, lon_col, "tag").distinct()
    else:
        # Several zips for one coordinate: the smallest counts, whatever the row
        # order.  A zip's place among the chosen ones is a number of its own
        # order: 2 i + 1 for the i-th, an even number for one in between.  Its
        # minimum is a plain hash aggregate; text zips would have to be sorted.
        # (The at most 2k zips come to the driver to be written out as a literal.)
        zips = materialise(zips, "q3-zips")[0].hint(chosen_by["zips"] or "broadcast")
        kind = zips.schema[zip_col].dataType
        listed = F.array(*[F.lit(r[0]) for r in zips.select(zip_col).distinct().collect() if r[0] is not None])
        listed = listed.cast(ArrayType(kind))
        place = 2 * F.size(F.filter(listed, lambda z: z < F.col(zip_col))) + F.array_contains(
            listed, F.col(zip_col)
        ).cast("int")
        # Only coordinates that some chosen zip has can end up with one: they are
        # few, so all their rows are found by a second scan, not by a shuffle.
        held = keyed.join(zips.select(zip_col).distinct(), zip_col, "left_semi").select(lat_col, lon_col).distinct()
        held, n_held, held_bytes = materialise(held, "q3-coordinates")
        if n_held <= max_broadcast_rows and held_bytes <= DEFAULT_BROADCAST_BYTES:
            held = F.broadcast(held)
        unique = (
            keyed.where(F.col(zip_col).isNotNull())
            .join(held, [lat_col, lon_col], "left_semi")
            .groupBy(lat_col, lon_col)
            .agg(F.min(place).alias("__place"))
            .where(F.col("__place") % 2 == 1)
        )
        chosen = unique.join(zips.withColumn("__place", place), "__place").select(lat_col, lon_col, "tag")
    # Computed once and written to the shared scratch folder; the size
    # observed while writing decides whether the places are broadcast.
    chosen, n_places, places_bytes = materialise(chosen, "q3-places")
    small = n_places <= max_broadcast_rows and places_bytes <= DEFAULT_BROADCAST_BYTES
    if chosen_by["places"] == "broadcast" and not small:
        raise ValueError("the chosen places are beyond the broadcast bound; choose another strategy or None")
    if chosen_by["places"] is not None:
        chosen = chosen.hint(chosen_by["places"])
    elif small:
        # places go to every task: facts are joined where they are read and
        # only partial counts per (group, code) are shuffled
        chosen = F.broadcast(chosen)
    # Without a broadcast the facts are shuffled once on (lat, lon); AQE splits
    # a place holding a large share of them.  (Counting per (lat, lon, code)
    # first was measured: with few repeats per place it adds a second shuffle
    # and doubles the volume.)
    victims = where_not_null(facts.select(lat_col, lon_col, descent_col), descent_col)
    joined = victims.join(chosen, [lat_col, lon_col])
    counts = count_by(joined, ["tag", descent_col], "total victims")
    # without a strategy the planner broadcasts the code table on its size statistics
    code_texts = codes.select(descent_col, code_text_col)
    decoded = join_with_strategy(
        counts, code_texts, descent_col, chosen_by["codes"], max_broadcast_rows=max_broadcast_rows
    )
    result = decoded.select("tag", F.col(code_text_col).alias("victim descent"), "total victims")
    return sort_result(result, ["tag", F.col("total victims").desc(), F.col("victim descent").asc()])


# --------------------------------------------------------------------- Q4


def station_distance(
    incidents: DataFrame,
    stations: DataFrame,
    *,
    area_col: str = "AREA",
    station_area_col: str = "PREC",
    code_col: str = "Weapon Used Cd",
    code_range: tuple[int, int] | None = (100, 200),
    code_pattern: str | None = None,
    area_name_col: str | None = "AREA NAME",
    exclude_area_name: str | None = "Null Island",
    lat_col: str = "LAT",
    lon_col: str = "LON",
    station_lat_col: str = "Y",
    station_lon_col: str = "X",
    division_col: str = "DIVISION",
    drop_zero_coordinates: bool = False,
    digits: int | None = None,
    station_strategy: str | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    exact: bool = False,
) -> DataFrame:
    """Per division: incident count and mean distance (km) to its station.

    Incidents are kept when their code lies in ``code_range`` (half-open, on
    the code's int value) or, with ``code_pattern``, when the code text
    matches that regex anywhere.  Area keys are compared as ints, so
    ``'07'`` meets ``'7'``.  Result: division, average_distance, incidents total.

    ``station_strategy=None`` lets the planner broadcast the station table
    from its size statistics (a few kilobytes of Parquet); ``'broadcast'``
    adds an explicit size check and raises beyond it.  ``exact`` adds the
    distances without rounding, so the means do not depend on how the
    incidents are partitioned, bit for bit.
    """
    facts = incidents
    if area_name_col and exclude_area_name is not None:
        facts = where_not_equal(facts, area_name_col, exclude_area_name)
    if code_pattern is not None:
        facts = facts.filter(F.col(code_col).rlike(code_pattern))
    if code_range is not None:
        code = to_int(code_col)
        facts = facts.filter((code >= code_range[0]) & (code < code_range[1]))
    if drop_zero_coordinates:
        facts = facts.filter(~((F.col(lat_col).cast("double") == 0) & (F.col(lon_col).cast("double") == 0)))
    facts = facts.select(area_col, lat_col, lon_col)
    posts = stations.select(
        station_area_col,
        F.col(division_col).alias("division"),
        F.col(station_lat_col).alias("__station_lat"),
        F.col(station_lon_col).alias("__station_lon"),
    )
    joined = join_normalised(
        facts, posts, area_col, station_area_col, "__area", station_strategy, max_broadcast_rows
    )
    measured = with_geodesic_km(joined, lat_col, lon_col, "__station_lat", "__station_lon", "__distance")
    averaged = exact_mean if exact else avg_and_count
    per_division = averaged(
        measured, ["division"], "__distance", "average_distance", "incidents total", digits
    )
    return sort_result(per_division, [F.col("incidents total").desc(), F.col("division").asc()])
