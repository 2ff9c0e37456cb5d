"""Trip statistics by pickup location and the reports behind the dashboard
(SURVEY D3, D4, D7-D14).

Plan at scale
-------------
``trips_and_zones`` is a filtered scan (the time range and the column list
reach the Parquet reader) joined to the zone dimension. No broadcast hint:
the planner broadcasts the zones from their measured size, and AQE splits a
skewed pickup location if it falls back to a shuffle join.

``pickup_location_stats`` computes ``top_pickup_locations`` straight from
the trips: it folds the trips to one row per pickup location *before* the
join (partial aggregation, so a location with a third of all trips is one row
per map task), joins that small result to the zones, then sums per
(location, borough, zone). Counts and the NaN-skipping mean are carried as
(count, sum, count of numbers), which gives exactly what grouping the joined
rows gives, duplicate zone rows included.

The report functions take the per-location table (one row per pickup
location). They never collect it: top-N runs as ``TakeOrderedAndProject``,
statistics as aggregates, the exact median through ``exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions import (
    as_double,
    bucket_label,
    clean_avg,
    fmt_count,
    fmt_decimal,
    fmt_half_even,
    nan_to_null,
    round_half,
)
from tabflow.operators.checks import Check, is_floating
from tabflow.operators.incremental import MergeableState
from tabflow.operators.staging import export_csv
from tabflow.operators.relational import (
    complete_categories,
    describe_column,
    enrich,
    filter_in,
    filter_min,
    frequency,
    histogram,
    salted_enrich,
    top_n,
)
from tabflow.sources import scan

# Fixed values of the reference's taxi data product.
TRIP_COLUMNS = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles"]
WINDOW_START = "2021-02-01"
WINDOW_END = "2021-02-15"
LOCATION_KEYS = ["PULocationID", "Borough", "Zone"]
DISTANCE_EDGES = [0.0, 2.0, 4.0, 6.0, float("inf")]
DISTANCE_LABELS = ["Short (0-2mi)", "Medium (2-4mi)", "Long (4-6mi)", "Very Long (6+mi)"]
DEFAULT_LIMIT = 50
TOP_BARS = 20
HISTOGRAM_BINS = 30


def time_window(column: str, start: str | datetime, end: str | datetime) -> Column:
    """Half-open range ``start <= column < end``; null times are dropped.
    Text bounds are cast to the column's own timestamp type by the analyzer,
    so the comparison folds to a literal and reaches the Parquet reader."""
    return (F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end))


def trips_and_zones(
    trips: DataFrame,
    zones: DataFrame,
    start: str | datetime = WINDOW_START,
    end: str | datetime = WINDOW_END,
    columns: Sequence[str] | None = TRIP_COLUMNS,
    time_column: str = "pickup_datetime",
    trip_key: str = "PULocationID",
    zone_key: str = "LocationID",
    miles: str = "trip_miles",
    hot_fraction: float | None = None,
) -> DataFrame:
    """Trips in ``[start, end)`` with their pickup zone.

    Columns: the trip columns without ``miles``, then ``miles`` cast strictly
    to double (text that is not a number fails the job), then the zone
    columns without the zone key. Trips without a zone are dropped. A declared
    column that the trips lack is an error.
    With ``hot_fraction`` the join salts pickup locations that hold at least
    that share of the trips (for a zone table too large to broadcast);
    otherwise the planner and AQE's skew-join handling choose.
    """
    cols = list(columns or trips.columns)
    if missing := [c for c in cols if c not in trips.columns]:
        raise ValueError(f"trips lack the declared column(s) {missing}")
    selected = scan(trips, cols, time_window(time_column, start, end))
    fact = selected.select(
        *[F.col(f"`{c}`") for c in cols if c != miles],
        as_double(selected, miles).alias(miles),
    )
    if hot_fraction is not None:
        return salted_enrich(fact, zones, trip_key, zone_key, hot_fraction=hot_fraction)
    return enrich(fact, zones, trip_key, zone_key)


def trips_checks(miles: str = "trip_miles") -> list[Check]:
    """The schema expectation of the joined table (warn severity)."""
    return [is_floating(miles)]


def top_pickup_locations(
    trips_zones: DataFrame,
    keys: Sequence[str] = LOCATION_KEYS,
    time_column: str = "pickup_datetime",
    miles: str = "trip_miles",
    digits: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Per (location, borough, zone): ``number_of_trips`` (non-null pickup
    times) and ``avg_trip_distance`` (mean skipping null and NaN), most trips
    first (``ordered=False`` skips the global sort, for consumers that
    aggregate). Groups with a null key are dropped (pandas ``groupby``)."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    avg = clean_avg(miles)
    if digits is not None:
        avg = round_half(avg, digits)
    out = (
        trips_zones.where(present)
        .groupBy(*keys)
        .agg(F.count(time_column).alias("number_of_trips"), avg.alias("avg_trip_distance"))
    )
    return top_n(out, "number_of_trips", None, keys) if ordered else out


def pickup_location_stats(
    trips: DataFrame,
    zones: DataFrame,
    start: str | datetime = WINDOW_START,
    end: str | datetime = WINDOW_END,
    time_column: str = "pickup_datetime",
    trip_key: str = "PULocationID",
    zone_key: str = "LocationID",
    miles: str = "trip_miles",
    borough: str = "Borough",
    zone: str = "Zone",
    digits: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """``top_pickup_locations(trips_and_zones(trips, zones, start, end))``
    with the aggregation pushed below the join (same rows, same values)."""
    per_location = pickup_partials(trips, start, end, time_column, trip_key, miles)
    return locations_of_partials(per_location, zones, trip_key, zone_key, borough, zone, digits, ordered)


def pickup_partials(
    trips: DataFrame,
    start: str | datetime = WINDOW_START,
    end: str | datetime = WINDOW_END,
    time_column: str = "pickup_datetime",
    trip_key: str = "PULocationID",
    miles: str = "trip_miles",
) -> DataFrame:
    """Per pickup location: trips, sum of miles and count of miles that are
    numbers. All three add up, so partials of several imports can be merged."""
    selected = scan(trips, [trip_key, time_column, miles], time_window(time_column, start, end))
    x = nan_to_null(as_double(selected, miles))
    return (
        selected.where(F.col(trip_key).isNotNull())
        .groupBy(trip_key)
        .agg(
            F.count(time_column).alias("_trips"),
            F.sum(x).alias("_miles"),
            F.count(x).alias("_numbers"),
        )
    )


def pickup_state(start: str | datetime = WINDOW_START, end: str | datetime = WINDOW_END) -> MergeableState:
    """The mergeable state behind ``pickup_location_stats``, for ``refresh``."""
    return MergeableState(
        ["PULocationID"],
        lambda trips: pickup_partials(trips, start, end),
        {"_trips": "sum", "_miles": "sum", "_numbers": "sum"},
    )


def locations_of_partials(
    per_location: DataFrame,
    zones: DataFrame,
    trip_key: str = "PULocationID",
    zone_key: str = "LocationID",
    borough: str = "Borough",
    zone: str = "Zone",
    digits: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """The per-location table from ``pickup_partials`` or a merged state of them."""
    dim = zones.select(
        F.col(zone_key).alias(trip_key), F.col(borough).alias("Borough"), F.col(zone).alias("Zone")
    ).where(F.col("Borough").isNotNull() & F.col("Zone").isNotNull())
    avg = F.sum("_miles") / F.sum("_numbers")
    if digits is not None:
        avg = round_half(avg, digits)
    out = (
        per_location.join(dim, trip_key, "inner")
        .groupBy(trip_key, "Borough", "Zone")
        .agg(
            F.sum("_trips").cast("long").alias("number_of_trips"),
            F.when(F.sum("_numbers") > 0, avg).alias("avg_trip_distance"),
        )
        .withColumnRenamed(trip_key, "PULocationID")
    )
    return top_n(out, "number_of_trips", None, LOCATION_KEYS) if ordered else out


def displayed(locations: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """The rows the dashboard shows: most trips first, the top ``limit``
    (10/25/50/100) or all for ``None``. Ties go to the lower location id."""
    return top_n(locations, "number_of_trips", limit, LOCATION_KEYS)


def _shown(locations: DataFrame, limit: int | None) -> DataFrame:
    """The displayed rows for a consumer that does not care about their order
    (an aggregate): the top ``limit``, or the table itself for ``None`` so no
    global sort is planned under the aggregate."""
    return locations if limit is None else displayed(locations, limit)


def location_kpis(locations: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """One row over the displayed locations: total trips, unweighted mean of
    the per-location average distances, and the top location with its trips."""
    shown = _shown(locations, limit)
    first_key = F.struct(-F.col("number_of_trips"), F.col("PULocationID"), F.col("Borough"), F.col("Zone"))
    return shown.agg(
        F.coalesce(F.sum("number_of_trips"), F.lit(0)).cast("long").alias("total_trips"),
        clean_avg("avg_trip_distance").alias("avg_distance"),
        F.min_by("Zone", first_key).alias("top_location"),
        F.max("number_of_trips").alias("top_location_trips"),
    )


def top_bars(locations: DataFrame, limit: int | None = DEFAULT_LIMIT, n: int = TOP_BARS) -> DataFrame:
    """The rows of the bar chart: the first ``n`` of the displayed locations."""
    bars = n if limit is None else min(n, limit)
    return displayed(locations, bars).select("Zone", "number_of_trips", "avg_trip_distance", "Borough")


def borough_mix(locations: DataFrame, limit: int | None = DEFAULT_LIMIT, n: int = TOP_BARS) -> DataFrame:
    """How many of the first ``n`` displayed locations lie in each borough."""
    return frequency(top_bars(locations, limit, n), "Borough", "count")


def trip_statistics(locations: DataFrame, limit: int | None = DEFAULT_LIMIT, digits: int | None = None) -> DataFrame:
    """Mean, exact median, sample std, min and max of ``number_of_trips``
    over the displayed locations."""
    return describe_column(_shown(locations, limit), "number_of_trips", digits)


# The metric names of the trip statistics table, with the columns they show.
STATISTICS = [
    ("Mean Trips", "mean"),
    ("Median Trips", "median"),
    ("Std Dev Trips", "std"),
    ("Min Trips", "min"),
    ("Max Trips", "max"),
]
KPI_AVERAGE_DIGITS = 2


def statistics_text(statistics: DataFrame) -> DataFrame:
    """The one-row ``trip_statistics`` as the displayed table: Metric, Value
    (whole numbers with separators; a missing value is ``nan``)."""
    rows = [
        F.struct(F.lit(i).alias("o"), F.lit(name).alias("Metric"), F.coalesce(fmt_half_even(c, 0), F.lit("nan")).alias("Value"))
        for i, (name, c) in enumerate(STATISTICS)
    ]
    return statistics.select(F.inline(F.array(*rows))).orderBy("o").select("Metric", "Value")


def kpis_text(kpis: DataFrame) -> DataFrame:
    """The one-row ``location_kpis`` as displayed: total trips and the top
    location's trips with separators, the average distance with two decimals."""
    return kpis.select(
        fmt_count("total_trips").alias("total_trips_text"),
        fmt_half_even("avg_distance", KPI_AVERAGE_DIGITS).alias("avg_distance_text"),
        "top_location",
        fmt_count("top_location_trips").alias("top_location_trips_text"),
    )


def borough_report_text(report: DataFrame) -> DataFrame:
    """``borough_report`` as displayed: separators, two decimals, whole zones."""
    return report.select(
        "Borough",
        fmt_count("Total Trips").alias("Total Trips"),
        fmt_decimal("Avg Distance", 2).alias("Avg Distance"),
        F.col("Number of Zones").cast("string").alias("Number of Zones"),
    )


# The report headings ("Total Trips", "Avg Distance", "Number of Zones", "Distance Category") below.
def borough_report(locations: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """Per borough: total trips, unweighted mean of location averages, number
    of zones; most trips first. Null boroughs are dropped."""
    return (
        _shown(locations, limit)
        .where(F.col("Borough").isNotNull())
        .groupBy("Borough")
        .agg(
            F.sum("number_of_trips").cast("long").alias("Total Trips"),
            clean_avg("avg_trip_distance").alias("Avg Distance"),
            F.count("Zone").alias("Number of Zones"),
        )
        .orderBy(F.col("`Total Trips`").desc(), F.col("Borough"))
    )


def distance_points(locations: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """Trips against average distance, one point per displayed location."""
    return displayed(locations, limit).select(
        "PULocationID", "Borough", "Zone", "avg_trip_distance", "number_of_trips"
    )


def distance_histogram(
    locations: DataFrame, limit: int | None = DEFAULT_LIMIT, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width histogram of the per-location average distances."""
    return histogram(_shown(locations, limit), "avg_trip_distance", bins)


def distance_categories(
    locations: DataFrame,
    limit: int | None = DEFAULT_LIMIT,
    edges: Sequence[float] = DISTANCE_EDGES,
    labels: Sequence[str] = DISTANCE_LABELS,
) -> DataFrame:
    """Trips and zones per distance category, every category listed (0 when
    empty). Categories are right-closed; 0, negative, NaN and null averages
    fall in none."""
    category = bucket_label("avg_trip_distance", edges, labels)
    agg = (
        _shown(locations, limit)
        .withColumn("Distance Category", category)
        .where(F.col("`Distance Category`").isNotNull())
        .groupBy("Distance Category")
        .agg(
            F.sum("number_of_trips").cast("long").alias("Total Trips"),
            F.count("Zone").alias("Number of Zones"),
        )
    )
    return complete_categories(agg, "Distance Category", labels, {"Total Trips": 0, "Number of Zones": 0})


def filter_options(locations: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """The choices of the table filters: sorted distinct boroughs, each row
    carrying the largest trip count (the upper bound of the minimum filter)."""
    per_borough = _shown(locations, limit).groupBy("Borough").agg(F.max("number_of_trips").alias("max_trips"))
    # one row per borough, so the maximum over all of them is a window over a handful of rows
    widest = per_borough.withColumn("max_trips", F.max("max_trips").over(Window.partitionBy()))
    return widest.where(F.col("Borough").isNotNull()).orderBy("Borough")


def filtered_locations(
    locations: DataFrame,
    boroughs: Sequence[str] | None = None,
    min_trips: int = 0,
    limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """The location table after the borough and minimum-trips filters, with
    display text (``1,234`` and ``4.30``)."""
    out = filter_min(filter_in(displayed(locations, limit), "Borough", boroughs), "number_of_trips", min_trips)
    return out.select(
        *LOCATION_KEYS,
        "number_of_trips",
        "avg_trip_distance",
        fmt_count("number_of_trips").alias("number_of_trips_text"),
        fmt_decimal("avg_trip_distance", 2).alias("avg_trip_distance_text"),
    )


def top_locations_sql(locations: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """The dashboard's query text over the location table, run through
    ``spark.sql`` with the DataFrame bound as a parameter (no global view)."""
    text = (
        "SELECT PULocationID, Borough, Zone, number_of_trips, avg_trip_distance FROM {locs} "
        "ORDER BY number_of_trips DESC, PULocationID, Borough, Zone"
    )
    if limit is not None:
        text += f" LIMIT {int(limit)}"
    return locations.sparkSession.sql(text, locs=locations)


def export_filtered_locations(
    locations: DataFrame,
    path: str,
    boroughs: Sequence[str] | None = None,
    min_trips: int = 0,
    limit: int | None = DEFAULT_LIMIT,
) -> None:
    """CSV download of the table as filtered on screen (one file of ``limit``
    rows at most; with ``limit=None`` every task writes a part)."""
    out = filtered_locations(locations, boroughs, min_trips, limit).select(
        *LOCATION_KEYS, "number_of_trips", "avg_trip_distance"
    )
    export_csv(out, path, limit)
