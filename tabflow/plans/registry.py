"""Registered queries over the test tables and their DuckDB oracle SQL.

Every query reads whole tables at ``sf_dir`` through ``bindings``. Miles are
multiples of 1/4, so their sums and means are the same in any order; means of
means and the like are rounded to 6 decimals on both sides at the very end. The
conversion rate keeps the original's 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions import round_half
from tabflow.operators.checks import field_is, is_floating, run_checks, unique
from tabflow.operators.copartition import read_copartitioned, stage_copartitioned
from tabflow.operators.incremental import refresh
from tabflow.operators.quantiles import exact_quantiles
from tabflow.operators.relational import describe_column, row_count
from tabflow.operators.sketches import DEFAULT_K, rank_error, sketch_state, sketched_quantiles
from tabflow.operators.staging import (
    export_csv,
    export_csv_ordered,
    new_ref,
    publish,
    query,
    read_csv_ordered,
    read_range,
    read_table,
    stage_table,
    staged_path,
    write_audit,
    write_table,
)
from tabflow.operators.versions import publish_version, read_version, write_version
from tabflow.plans import bindings as B
from tabflow.plans import conversion, engagement, trips
from tabflow.plans.flows import import_table
from tabflow.sources import detect_schema, field_type, override_types, read_parquet_glob, read_source
from tabflow.sources.csv_records import read_csv_records

DIGITS = 6
# Fixed parameters of the registered report queries.
FILTER_BOROUGHS = ["ASIA", "EUROPE"]
FILTER_MIN_TRIPS = 3
TOP_TEN = 10
TOP_SQL = 25
HOT_FRACTION = 0.01


def _round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(
        *[
            round_half(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- conversion


def q_session_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.session_conversion(B.session_events(spark, sf))


def q_conversion_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.conversion_by_segment(q_session_conversion(spark, sf), B.users(spark, sf))


def q_conversion_kpis(spark: SparkSession, sf: str) -> DataFrame:
    by_segment = conversion.conversion_by_segment(q_session_conversion(spark, sf), B.users(spark, sf), ordered=False)
    return conversion.conversion_kpis(by_segment)


def q_conversion_kpis_text(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.kpis_text(q_conversion_kpis(spark, sf))


def q_segment_table(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.display_names(q_segment_report(spark, sf))


def q_segment_report(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.segment_report(q_conversion_by_segment(spark, sf))


def q_best_segment(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.best_segment(q_conversion_by_segment(spark, sf))


def q_checks_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return run_checks(q_conversion_by_segment(spark, sf), conversion.conversion_checks())


# --------------------------------------------------------------------- trips


def q_trips_and_zones(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trips_and_zones(B.trips(spark, sf), B.zones(spark, sf), B.TRIP_START, B.TRIP_END)


def q_trips_and_zones_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same join with hot pickup locations salted (here: any location with
    at least 1% of the trips in the window)."""
    return trips.trips_and_zones(
        B.trips(spark, sf), B.zones(spark, sf), B.TRIP_START, B.TRIP_END, hot_fraction=HOT_FRACTION
    )


def locations(
    spark: SparkSession, sf: str, ordered: bool = False, start: str = B.TRIP_START, end: str = B.TRIP_END
) -> DataFrame:
    """Per-location statistics (D4), aggregated below the join. The reports
    take it unordered and unrounded: they sort or aggregate it themselves."""
    return trips.pickup_location_stats(B.trips(spark, sf), B.zones(spark, sf), start, end, ordered=ordered)


def all_locations(spark: SparkSession, sf: str) -> DataFrame:
    """The same over every ship date, so the reports see all trips and zones."""
    return locations(spark, sf, start=B.ALL_START, end=B.ALL_END)


def q_top_pickup_locations(spark: SparkSession, sf: str) -> DataFrame:
    return locations(spark, sf, ordered=True)


def q_top_pickup_locations_joined(spark: SparkSession, sf: str) -> DataFrame:
    return trips.top_pickup_locations(q_trips_and_zones(spark, sf))


def q_top_locations_10(spark: SparkSession, sf: str) -> DataFrame:
    return trips.displayed(locations(spark, sf), TOP_TEN)


def q_top_locations_sql(spark: SparkSession, sf: str) -> DataFrame:
    return trips.top_locations_sql(locations(spark, sf), TOP_SQL)


def q_location_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trips.location_kpis(locations(spark, sf), trips.DEFAULT_LIMIT))


def q_location_kpis_all(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trips.location_kpis(locations(spark, sf), None))


def q_borough_mix_top20(spark: SparkSession, sf: str) -> DataFrame:
    return trips.borough_mix(locations(spark, sf))


def q_borough_mix_top10(spark: SparkSession, sf: str) -> DataFrame:
    """With the top ten displayed, the mix covers those ten."""
    return trips.borough_mix(locations(spark, sf), TOP_TEN)


def q_top_bars(spark: SparkSession, sf: str) -> DataFrame:
    return trips.top_bars(locations(spark, sf))


def q_top_pickup_locations_all_dates(spark: SparkSession, sf: str) -> DataFrame:
    return trips.displayed(all_locations(spark, sf), None)


def q_trip_statistics_all_dates(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trip_statistics(all_locations(spark, sf), None, DIGITS)


def q_borough_report_all_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trips.borough_report(all_locations(spark, sf), None))


def q_distance_histogram_all_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trips.distance_histogram(all_locations(spark, sf), None))


def q_distance_categories_all_dates(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distance_categories(all_locations(spark, sf), None)


def q_price_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of every line item's price."""
    li = B.table(spark, sf, "lineitem")
    return _round_doubles(exact_quantiles(li, "l_extendedprice", [0.1, 0.5, 0.9], ["p10", "median", "p90"]))


def q_price_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return describe_column(B.table(spark, sf, "lineitem"), "l_quantity", DIGITS)


def q_location_kpis_text(spark: SparkSession, sf: str) -> DataFrame:
    return trips.kpis_text(trips.location_kpis(locations(spark, sf)))


def q_trip_statistics_text(spark: SparkSession, sf: str) -> DataFrame:
    return trips.statistics_text(trips.trip_statistics(locations(spark, sf)))


def q_borough_report_text(spark: SparkSession, sf: str) -> DataFrame:
    return trips.borough_report_text(trips.borough_report(locations(spark, sf)))


def q_trip_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trip_statistics(locations(spark, sf), None, DIGITS)


def q_trip_statistics_top50(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trip_statistics(locations(spark, sf), trips.DEFAULT_LIMIT, DIGITS)


def q_borough_report(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trips.borough_report(locations(spark, sf), None))


def q_distance_points(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distance_points(locations(spark, sf), None)


def q_distance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trips.distance_histogram(locations(spark, sf), None))


def q_distance_categories(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distance_categories(locations(spark, sf), None)


def q_distance_categories_top50(spark: SparkSession, sf: str) -> DataFrame:
    return trips.distance_categories(locations(spark, sf), trips.DEFAULT_LIMIT)


def q_filter_options(spark: SparkSession, sf: str) -> DataFrame:
    return trips.filter_options(locations(spark, sf), None)


def q_filtered_locations(spark: SparkSession, sf: str) -> DataFrame:
    return trips.filtered_locations(locations(spark, sf), FILTER_BOROUGHS, FILTER_MIN_TRIPS, None)


def q_filtered_location_count(spark: SparkSession, sf: str) -> DataFrame:
    filtered = trips.filtered_locations(locations(spark, sf), FILTER_BOROUGHS, FILTER_MIN_TRIPS, None)
    return row_count(filtered, "locations")


def q_checks_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """Key uniqueness of both dimensions (E9) and the type expectations of the
    joined trips (E6, E8), as one result table."""
    zone_checks = run_checks(B.zones(spark, sf), [unique("LocationID")])
    user_checks = run_checks(B.users(spark, sf), [unique("user_id")])
    joined = q_trips_and_zones(spark, sf)
    type_checks = run_checks(joined, [is_floating("trip_miles"), field_is("PULocationID", "bigint")])
    return zone_checks.unionByName(user_checks).unionByName(type_checks)


# ---------------------------------------------------------- import and types


def q_override_types_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Store two double columns as text, then cast them back strictly."""
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    as_text = override_types(li, {"l_quantity": "string", "l_extendedprice": "string"})
    both = as_text.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("l_quantity_text"),
        F.col("l_extendedprice").alias("l_extendedprice_text"),
        "l_quantity",
        "l_extendedprice",
    )
    return override_types(both, {"l_quantity": "double", "l_extendedprice": "double"})


def q_write_audit_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Import lineitem into a fresh staging ref with ``l_quantity`` stored as
    text, audit it (not empty, field type) and read the staged table back."""
    result = import_table(
        spark, f"{sf.rstrip('/')}/lineitem.parquet", "lineitem", overrides={"l_quantity": "string"}
    )
    return result.staged(spark)


def q_publish_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Import the orders into a ref, publish them and read the published table."""
    result = import_table(spark, f"{sf.rstrip('/')}/orders.parquet", "orders")
    target = staged_path(spark, "published.orders", new_ref("published"))
    publish(spark, "orders", result.ref, target)
    return read_table(spark, target)


def q_written_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The row count that a write reports, without a second pass."""
    _, rows = stage_table(B.table(spark, sf, "lineitem"), "lineitem", new_ref("rows"))
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows"))


def q_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Line items staged in folders by a text key with an empty value, one
    with leading zeros and one that starts with the mark of empty values."""
    flag = F.col("l_returnflag")
    key = F.when(flag == "A", "").when(flag == "N", "007").otherwise(F.concat(F.lit("="), flag))
    li = B.table(spark, sf, "lineitem").select("l_orderkey", key.alias("part"), "l_linenumber")
    result = write_audit(li, "lineitem", new_ref("partitioned"), [field_is("part", "string")], partition_by=["part"])
    return result.staged(spark)


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every document through CSV, with quotes, commas, outer spaces and line breaks."""
    text = F.concat(F.lit('  "'), F.col("text"), F.lit('", '))
    docs = B.table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang")
    path = staged_path(spark, "documents_csv", new_ref("csv"))
    export_csv(docs, path)
    return read_source(spark, path, "csv", "doc_id long, text string, lang string", {"multiLine": "true"})


def q_query_at_ref(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text over a staged table."""
    ref = new_ref("sql")
    stage_table(B.table(spark, sf, "lineitem"), "lineitem", ref)
    text = (
        "SELECT l_returnflag, COUNT(*) AS lines, SUM(l_quantity) AS quantity FROM {lineitem} "
        "WHERE l_linenumber > 1 GROUP BY l_returnflag ORDER BY l_returnflag"
    )
    return query(spark, text, ref)


def q_detected_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Columns, detected types and values of line items that stand in folders of
    several files, one of which lacks a column."""
    base = staged_path(spark, "drifting", new_ref("schema"))
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_tax")
    full = F.col("l_orderkey") % 3 > 0
    li.where(full).repartition(6).write.parquet(f"{base}/full")
    li.where(~full).drop("l_tax").repartition(3).write.parquet(f"{base}/short")
    df = read_parquet_glob(spark, f"{base}/*")
    names = detect_schema(spark, f"{base}/*").names
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.lit(field_type(df, c)).alias("type"), F.col(c).alias("n_values")) for c in names]
    )
    return counts.select(F.inline(rows))


def q_csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every document through CSV files with line breaks in fields, read in splits."""
    text = F.concat(F.lit('  "'), F.col("text"), F.lit('",\n '), F.col("text"))
    docs = B.table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang")
    path = staged_path(spark, "documents_csv", new_ref("records"))
    export_csv(docs, path)
    return read_csv_records(spark, path, "doc_id bigint, text string, lang string")


def q_query_plain_names(spark: SparkSession, sf: str) -> DataFrame:
    """The row count of a staged table of a namespace, in SQL by its plain name."""
    ref = new_ref("names")
    stage_table(B.table(spark, sf, "lineitem"), "staged.lineitem", ref)
    return query(spark, "SELECT COUNT(*) AS n FROM staged.lineitem", ref)


def q_publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the orders published one after the other by pointer, the
    second by folder of a text key; what a reader finds then."""
    target, orders = staged_path(spark, "published.orders", new_ref("versions")), B.table(spark, sf, "orders")
    for keep, keys in ((F.col("o_orderstatus") == "F", None), (F.lit(True), ["o_orderstatus"])):
        ref = new_ref("orders")
        write_audit(orders.where(keep), "orders", ref, [unique("o_orderkey")], partition_by=keys)
        publish_version(spark, "orders", ref, target)
    return read_version(spark, target)


def q_read_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The orders of one status in each of three versions, read by number and
    by time when the third is current."""
    path, orders = staged_path(spark, "history.orders", new_ref("history")), B.table(spark, sf, "orders")
    orders = orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    made = [write_version(orders.where(F.col("o_orderstatus") == status), path) for status in "FOP"]
    first = read_version(spark, path, version=made[0].number)
    second = read_version(spark, path, as_of=made[1].published_at)
    frames = [df.withColumn("version", F.lit(n)) for n, df in enumerate([first, second, read_version(spark, path)], 1)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def q_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Line items imported in three appends into folders by a text key with an
    empty value and one that starts with the mark of empty values."""
    flag, path = F.col("l_returnflag"), staged_path(spark, "lineitem", new_ref("append"))
    key = F.when(flag == "A", "").when(flag == "N", "007").otherwise(F.concat(F.lit("="), flag))
    li = B.table(spark, sf, "lineitem").select("l_orderkey", key.alias("part"), "l_linenumber")
    for part in range(3):
        write_table(li.where(F.col("l_linenumber") % 3 == part), path, "append", ["part"] if part == 0 else None)
    return read_table(spark, path)


IMPORTS = 3


def _imports(df: DataFrame, part: Column, folder: str):
    """``df`` arriving in ``IMPORTS`` batches of files; yields after each one."""
    for k in range(IMPORTS):
        df.where(part == k).write.mode("append").parquet(folder)
        yield k


def q_incremental_conversion(spark: SparkSession, sf: str) -> DataFrame:
    """Conversion by segment (D2) from a session state refreshed after each of
    three imports of events, whose sessions span the imports; each refresh runs
    twice, and the second finds no new file."""
    base = staged_path(spark, "incremental", new_ref("sessions"))
    events = B.session_events(spark, sf)
    for _ in _imports(events, F.pmod(F.xxhash64(*events.columns), F.lit(IMPORTS)), f"{base}/events"):
        for _ in range(2):
            refresh(spark, f"{base}/state", f"{base}/events", conversion.session_state())
    return conversion.conversion_by_segment(read_version(spark, f"{base}/state"), B.users(spark, sf))


def q_incremental_locations(spark: SparkSession, sf: str) -> DataFrame:
    """The per-location table over all dates (D4) from a state refreshed after
    each of three imports of trips."""
    base = staged_path(spark, "incremental", new_ref("trips"))
    state = trips.pickup_state(B.ALL_START, B.ALL_END)
    for _ in _imports(B.trips(spark, sf), F.pmod(F.coalesce(F.month("pickup_datetime"), F.lit(0)), F.lit(IMPORTS)), f"{base}/trips"):
        refresh(spark, f"{base}/state", f"{base}/trips", state)
    return trips.locations_of_partials(read_version(spark, f"{base}/state"), B.zones(spark, sf))


def q_clustered_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Trips staged in files clustered by pickup time, joined to their zones in the window."""
    path, _ = stage_table(B.trips(spark, sf), "trips", new_ref("clustered"), cluster_by=["pickup_datetime"])
    window = read_range(spark, path, "pickup_datetime", B.TRIP_START, B.TRIP_END)
    return trips.trips_and_zones(window, B.zones(spark, sf), B.TRIP_START, B.TRIP_END)


BUCKETS = 16


def q_copartitioned_trips(spark: SparkSession, sf: str) -> DataFrame:
    """All trips and their zones staged in the same buckets, hot locations
    salted, then joined in the window without a shuffle."""
    ref = new_ref("copartitioned")
    fact = B.trips(spark, sf).select(*trips.TRIP_COLUMNS)
    path = stage_copartitioned(
        fact, B.zones(spark, sf), "PULocationID", "LocationID", "trips_zones", ref, BUCKETS, hot_fraction=HOT_FRACTION
    )
    pair = read_copartitioned(spark, path)
    return pair.enriched(trips.time_window("pickup_datetime", B.TRIP_START, B.TRIP_END))


SKETCH_PROBABILITIES = (0.1, 0.5, 0.9)


def q_sketched_price_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of l_extendedprice per return flag from sketches refreshed
    over three imports. Each row tells whether the value's exact rank, counted
    over all rows, is within four times the stated rank error."""
    base = staged_path(spark, "sketches", new_ref("prices"))
    li = B.table(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", "l_extendedprice")
    for _ in _imports(li, F.pmod(F.col("l_linenumber"), F.lit(IMPORTS)), f"{base}/lineitem"):
        state = sketch_state(["l_returnflag"], "l_extendedprice")
        refresh(spark, f"{base}/state", f"{base}/lineitem", state)
    found = sketched_quantiles(read_version(spark, f"{base}/state"), SKETCH_PROBABILITIES)
    cuts = found.groupBy("l_returnflag").pivot("p", list(SKETCH_PROBABILITIES)).agg(F.first("value"))
    price, columns = F.col("l_extendedprice").cast("double"), [F.col(f"`{p}`") for p in SKETCH_PROBABILITIES]
    ranks = [
        F.struct(F.lit(p).alias("p"), F.count_if(price < c).alias("below"), F.count_if(price <= c).alias("upto"))
        for p, c in zip(SKETCH_PROBABILITIES, columns, strict=True)
    ]
    counted = li.join(cuts, "l_returnflag").groupBy("l_returnflag").agg(F.array(*ranks).alias("ranks"), F.count(price).alias("exact_n"))
    slack = F.lit(4 * rank_error(DEFAULT_K)) * F.col("exact_n")
    rank = F.col("p") * F.col("exact_n")
    return (
        counted.select("l_returnflag", "exact_n", F.inline("ranks"))
        .join(found, ["l_returnflag", "p"])
        .select("l_returnflag", "p", "n", ((F.col("below") <= rank + slack) & (F.col("upto") >= rank - slack)).alias("within"))
    )


def q_ordered_export(spark: SparkSession, sf: str) -> DataFrame:
    """All locations exported in report order by several tasks and read back
    with their position."""
    path = staged_path(spark, "locations_csv", new_ref("ordered"))
    order = [F.desc("number_of_trips"), *trips.LOCATION_KEYS]
    table = all_locations(spark, sf)
    export_csv_ordered(table, path, order, parts=4)
    return read_csv_ordered(spark, path, table.schema)


def q_glob_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Line items whose files disagree on the type of l_quantity."""
    base = staged_path(spark, "mixed", new_ref("glob"))
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    odd = F.col("l_linenumber") % 2 == 1
    li.where(odd).write.parquet(f"{base}/numbers")
    override_types(li.where(~odd), {"l_quantity": "string"}).write.parquet(f"{base}/text")
    return read_parquet_glob(spark, f"{base}/*", {"l_quantity": "double"})


# ---------------------------------------------------------------- engagement


def q_engagement_user_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(engagement.user_segments(B.engagement_users(spark, sf)))


def q_engagement_segments(spark: SparkSession, sf: str) -> DataFrame:
    seg = engagement.user_segments(B.engagement_users(spark, sf))
    return _round_doubles(engagement.segment_summary(seg))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "session_conversion": q_session_conversion,
    "conversion_by_segment": q_conversion_by_segment,
    "conversion_kpis": q_conversion_kpis,
    "segment_report": q_segment_report,
    "best_segment": q_best_segment,
    "checks_conversion": q_checks_conversion,
    "trips_and_zones": q_trips_and_zones,
    "trips_and_zones_salted": q_trips_and_zones_salted,
    "top_pickup_locations": q_top_pickup_locations,
    "top_pickup_locations_joined": q_top_pickup_locations_joined,
    "top_locations_10": q_top_locations_10,
    "top_locations_sql": q_top_locations_sql,
    "location_kpis": q_location_kpis,
    "location_kpis_all": q_location_kpis_all,
    "borough_mix_top20": q_borough_mix_top20,
    "trip_statistics": q_trip_statistics,
    "trip_statistics_top50": q_trip_statistics_top50,
    "borough_report": q_borough_report,
    "distance_points": q_distance_points,
    "distance_histogram": q_distance_histogram,
    "distance_categories": q_distance_categories,
    "distance_categories_top50": q_distance_categories_top50,
    "filter_options": q_filter_options,
    "filtered_locations": q_filtered_locations,
    "filtered_location_count": q_filtered_location_count,
    "checks_dimensions": q_checks_dimensions,
    "override_types_roundtrip": q_override_types_roundtrip,
    "write_audit_roundtrip": q_write_audit_roundtrip,
    "engagement_user_segments": q_engagement_user_segments,
    "engagement_segments": q_engagement_segments,
    "conversion_kpis_text": q_conversion_kpis_text,
    "segment_table": q_segment_table,
    "borough_mix_top10": q_borough_mix_top10,
    "top_bars": q_top_bars,
    "top_pickup_locations_all_dates": q_top_pickup_locations_all_dates,
    "trip_statistics_all_dates": q_trip_statistics_all_dates,
    "borough_report_all_dates": q_borough_report_all_dates,
    "distance_histogram_all_dates": q_distance_histogram_all_dates,
    "distance_categories_all_dates": q_distance_categories_all_dates,
    "price_quantiles": q_price_quantiles,
    "price_statistics": q_price_statistics,
    "location_kpis_text": q_location_kpis_text,
    "trip_statistics_text": q_trip_statistics_text,
    "borough_report_text": q_borough_report_text,
    "publish_roundtrip": q_publish_roundtrip,
    "written_rows": q_written_rows,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "query_at_ref": q_query_at_ref,
    "glob_mixed_types": q_glob_mixed_types,
    "detected_schema": q_detected_schema,
    "csv_records": q_csv_records,
    "query_plain_names": q_query_plain_names,
    "publish_versions": q_publish_versions,
    "read_as_of": q_read_as_of,
    "append_roundtrip": q_append_roundtrip,
    "incremental_conversion": q_incremental_conversion,
    "incremental_locations": q_incremental_locations,
    "clustered_trips": q_clustered_trips,
    "copartitioned_trips": q_copartitioned_trips,
    "sketched_price_quantiles": q_sketched_price_quantiles,
    "ordered_export": q_ordered_export,
}
