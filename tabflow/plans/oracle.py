"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The views ``region nation customer supplier part orders lineitem events ...``
are registered by the caller. Column names and types match the Spark side.
"""

from __future__ import annotations

_SESSIONS = """
ev AS (
    SELECT concat(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS user_session,
           user_id, event_type
    FROM events
),
sc AS (
    SELECT user_session,
           MAX(user_id) AS user_id,
           MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS converted
    FROM ev
    WHERE user_session IS NOT NULL
    GROUP BY user_session
),
users AS (
    SELECT c_custkey AS user_id,
           CASE WHEN c_acctbal >= 6000 THEN 'high'
                WHEN c_acctbal >= 2500 THEN 'medium'
                WHEN c_acctbal IS NOT NULL THEN 'low' END AS customer_segment
    FROM customer
),
cbs AS (
    SELECT u.customer_segment,
           COUNT(*) AS total_sessions,
           CAST(SUM(s.converted) AS BIGINT) AS converting_sessions,
           ROUND(SUM(s.converted) * 1.0 / COUNT(*), 4) AS conversion_rate
    FROM sc s JOIN users u ON s.user_id = u.user_id
    WHERE u.customer_segment IS NOT NULL
    GROUP BY u.customer_segment
)"""

_SEGMENT_RANK = (
    "CASE customer_segment WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 99 END"
)

def _zones(start: str, end: str) -> str:
    return f"""
zones AS (
    SELECT s.s_suppkey AS LocationID, r.r_name AS Borough, s.s_name AS Zone
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
trips AS (
    SELECT l_shipdate AS pickup_datetime, l_shipdate + INTERVAL 1 DAY AS dropoff_datetime,
           l_suppkey AS PULocationID, l_partkey AS DOLocationID, l_quantity / 4.0 AS trip_miles
    FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '{start}' AND l_shipdate < TIMESTAMP '{end}'
),
tz AS (
    SELECT t.pickup_datetime, t.dropoff_datetime, t.PULocationID, t.DOLocationID,
           CAST(t.trip_miles AS DOUBLE) AS trip_miles, z.Borough, z.Zone
    FROM trips t JOIN zones z ON t.PULocationID = z.LocationID
),
loc AS (
    SELECT PULocationID, Borough, Zone,
           COUNT(pickup_datetime) AS number_of_trips,
           AVG(CASE WHEN isnan(trip_miles) THEN NULL ELSE trip_miles END) AS avg_trip_distance
    FROM tz
    WHERE PULocationID IS NOT NULL AND Borough IS NOT NULL AND Zone IS NOT NULL
    GROUP BY PULocationID, Borough, Zone
)"""


_ZONES = _zones("1998-02-01", "1998-02-15")
_ALL_ZONES = _zones("1990-01-01", "2000-01-01")

_ORDER = "ORDER BY number_of_trips DESC, PULocationID, Borough, Zone"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _top(n: int) -> str:
    return f"\ntop AS (SELECT * FROM loc {_ORDER} LIMIT {n})"


def _check(name: str, column: str, expr: str, source: str = "cbs", severity: str = "fail") -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity, "
        f"CAST({expr} AS BIGINT) AS violations, CAST({expr} AS BIGINT) = 0 AS passed FROM {source}"
    )


_ENGAGEMENT = """
u AS (
    SELECT user_id,
           CAST(COUNT(*) AS DOUBLE) AS user_engagement_score,
           AVG(value) AS daily_active_minutes_instagram
    FROM events WHERE user_id IS NOT NULL GROUP BY user_id
),
q AS (
    SELECT quantile_cont(user_engagement_score, 1.0 / 3.0) AS lo,
           quantile_cont(user_engagement_score, 2.0 / 3.0) AS hi
    FROM u
),
seg AS (
    SELECT u.*,
           CASE WHEN u.user_engagement_score <= q.lo THEN 'low'
                WHEN u.user_engagement_score <= q.hi THEN 'medium'
                WHEN u.user_engagement_score IS NOT NULL THEN 'high' END AS engagement_segment
    FROM u, q
)"""

_DISTANCE_CASE = """CASE WHEN avg_trip_distance IS NULL OR isnan(avg_trip_distance) THEN NULL
            WHEN avg_trip_distance > 0 AND avg_trip_distance <= 2 THEN 'Short (0-2mi)'
            WHEN avg_trip_distance > 2 AND avg_trip_distance <= 4 THEN 'Medium (2-4mi)'
            WHEN avg_trip_distance > 4 AND avg_trip_distance <= 6 THEN 'Long (4-6mi)'
            WHEN avg_trip_distance > 6 THEN 'Very Long (6+mi)' END"""

_HISTOGRAM = """,
v AS (SELECT avg_trip_distance AS x FROM loc WHERE isfinite(avg_trip_distance)),
b AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
counted AS (
    SELECT LEAST(CAST(FLOOR(30 * (v.x - b.lo) / (b.hi - b.lo)) AS BIGINT) + 1, 30) AS bin, COUNT(*) AS n
    FROM v, b GROUP BY 1
)
SELECT CAST(r.bin AS BIGINT) AS bin,
       ROUND(lo + (r.bin - 1) * ((hi - lo) / 30), 6) AS bin_start,
       ROUND(lo + r.bin * ((hi - lo) / 30), 6) AS bin_end,
       COALESCE(c.n, 0) AS count
FROM range(1, 31) AS r(bin) CROSS JOIN b LEFT JOIN counted c ON c.bin = r.bin"""

_CATEGORIES = f""",
cats AS (
    SELECT * FROM (VALUES ('Short (0-2mi)', 0), ('Medium (2-4mi)', 1),
                          ('Long (4-6mi)', 2), ('Very Long (6+mi)', 3)) AS t(cat, ord)
),
binned AS (SELECT {_DISTANCE_CASE} AS cat, number_of_trips, Zone FROM loc),
agg AS (
    SELECT cat, SUM(number_of_trips) AS trips, COUNT(Zone) AS zones
    FROM binned WHERE cat IS NOT NULL GROUP BY cat
)
SELECT c.cat AS "Distance Category",
       CAST(COALESCE(a.trips, 0) AS BIGINT) AS "Total Trips",
       CAST(COALESCE(a.zones, 0) AS BIGINT) AS "Number of Zones"
FROM cats c LEFT JOIN agg a ON c.cat = a.cat"""

_STATISTICS = """
SELECT COUNT(number_of_trips) AS count,
       ROUND(AVG(number_of_trips), 6) AS mean,
       ROUND(MEDIAN(number_of_trips), 6) AS median,
       ROUND(STDDEV_SAMP(number_of_trips), 6) AS std,
       CAST(MIN(number_of_trips) AS DOUBLE) AS min,
       CAST(MAX(number_of_trips) AS DOUBLE) AS max
FROM loc"""

_BOROUGHS = """
SELECT Borough,
       CAST(SUM(number_of_trips) AS BIGINT) AS "Total Trips",
       ROUND(AVG(avg_trip_distance), 6) AS "Avg Distance",
       COUNT(Zone) AS "Number of Zones"
FROM loc WHERE Borough IS NOT NULL GROUP BY Borough"""

LINEITEM_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

ORACLE_SQL: dict[str, str] = {
    "session_conversion": _with(_SESSIONS) + "\nSELECT user_session, user_id, converted FROM sc",
    "conversion_by_segment": _with(_SESSIONS) + "\nSELECT * FROM cbs ORDER BY conversion_rate DESC",
    "conversion_kpis": _with(_SESSIONS)
    + f"""
SELECT CAST(COALESCE(SUM(total_sessions), 0) AS BIGINT) AS total_sessions,
       CAST(COALESCE(SUM(converting_sessions), 0) AS BIGINT) AS converting_sessions,
       (SELECT customer_segment FROM cbs
        ORDER BY conversion_rate DESC, {_SEGMENT_RANK}, customer_segment LIMIT 1) AS best_segment,
       CASE WHEN COALESCE(SUM(total_sessions), 0) <> 0
            THEN CAST(SUM(converting_sessions) AS DOUBLE) / CAST(SUM(total_sessions) AS DOUBLE)
            ELSE 0.0 END AS overall_rate
FROM cbs""",
    "segment_report": _with(_SESSIONS)
    + """
SELECT customer_segment, total_sessions, converting_sessions, conversion_rate,
       conversion_rate * 100.0 AS conversion_pct,
       format('{:,}', total_sessions) AS sessions_text,
       format('{:,}', converting_sessions) AS conversions_text,
       printf('%.2f%%', conversion_rate * 100.0) AS conversion_rate_text
FROM cbs""",
    "best_segment": _with(_SESSIONS)
    + f"\nSELECT * FROM cbs ORDER BY conversion_rate DESC, {_SEGMENT_RANK}, customer_segment LIMIT 1",
    "checks_conversion": _with(_SESSIONS)
    + "\n"
    + "\nUNION ALL\n".join(
        [
            _check("no_nulls", "customer_segment", "COUNT_IF(customer_segment IS NULL)"),
            _check(
                "accepted_values",
                "customer_segment",
                "COUNT_IF(customer_segment IS NOT NULL AND customer_segment NOT IN ('high', 'medium', 'low'))",
            ),
            _check("no_nulls", "conversion_rate", "COUNT_IF(conversion_rate IS NULL)"),
            _check("in_range", "conversion_rate", "COUNT_IF(conversion_rate < 0 OR conversion_rate > 1)"),
            _check(
                "no_nulls_all",
                "total_sessions,converting_sessions",
                "COUNT_IF(total_sessions IS NULL) + COUNT_IF(converting_sessions IS NULL)",
            ),
            _check(
                "counts_valid",
                "total_sessions,converting_sessions",
                "COUNT_IF(NOT (total_sessions >= 0 AND converting_sessions >= 0"
                " AND converting_sessions <= total_sessions))",
            ),
            _check("not_empty", "", "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END"),
        ]
    ),
    "trips_and_zones": _with(_ZONES) + "\nSELECT * FROM tz",
    "trips_and_zones_salted": _with(_ZONES) + "\nSELECT * FROM tz",
    "top_pickup_locations": _with(_ZONES) + f"\nSELECT * FROM loc {_ORDER}",
    "top_pickup_locations_joined": _with(_ZONES) + f"\nSELECT * FROM loc {_ORDER}",
    "top_locations_10": _with(_ZONES) + f"\nSELECT * FROM loc {_ORDER} LIMIT 10",
    "top_locations_sql": _with(_ZONES) + f"\nSELECT * FROM loc {_ORDER} LIMIT 25",
    "location_kpis": _with(_ZONES, _top(50))
    + f"""
SELECT CAST(COALESCE(SUM(number_of_trips), 0) AS BIGINT) AS total_trips,
       ROUND(AVG(avg_trip_distance), 6) AS avg_distance,
       (SELECT Zone FROM top {_ORDER} LIMIT 1) AS top_location,
       MAX(number_of_trips) AS top_location_trips
FROM top""",
    "location_kpis_all": _with(_ZONES)
    + f"""
SELECT CAST(COALESCE(SUM(number_of_trips), 0) AS BIGINT) AS total_trips,
       ROUND(AVG(avg_trip_distance), 6) AS avg_distance,
       (SELECT Zone FROM loc {_ORDER} LIMIT 1) AS top_location,
       MAX(number_of_trips) AS top_location_trips
FROM loc""",
    "borough_mix_top20": _with(_ZONES, _top(20))
    + "\nSELECT Borough, COUNT(*) AS count FROM top WHERE Borough IS NOT NULL GROUP BY Borough",
    "trip_statistics": _with(_ZONES) + _STATISTICS,
    "trip_statistics_top50": _with(_ZONES, _top(50))
    + """
SELECT COUNT(number_of_trips) AS count,
       ROUND(AVG(number_of_trips), 6) AS mean,
       ROUND(MEDIAN(number_of_trips), 6) AS median,
       ROUND(STDDEV_SAMP(number_of_trips), 6) AS std,
       CAST(MIN(number_of_trips) AS DOUBLE) AS min,
       CAST(MAX(number_of_trips) AS DOUBLE) AS max
FROM top""",
    "borough_report": _with(_ZONES) + _BOROUGHS,
    "distance_points": _with(_ZONES)
    + "\nSELECT PULocationID, Borough, Zone, avg_trip_distance, number_of_trips FROM loc",
    "distance_histogram": _with(_ZONES) + _HISTOGRAM,
    "distance_categories": _with(_ZONES) + _CATEGORIES,
    "distance_categories_top50": _with(_ZONES, _top(50))
    + f""",
cats AS (
    SELECT * FROM (VALUES ('Short (0-2mi)', 0), ('Medium (2-4mi)', 1),
                          ('Long (4-6mi)', 2), ('Very Long (6+mi)', 3)) AS t(cat, ord)
),
binned AS (SELECT {_DISTANCE_CASE} AS cat, number_of_trips, Zone FROM top),
agg AS (
    SELECT cat, SUM(number_of_trips) AS trips, COUNT(Zone) AS zones
    FROM binned WHERE cat IS NOT NULL GROUP BY cat
)
SELECT c.cat AS "Distance Category",
       CAST(COALESCE(a.trips, 0) AS BIGINT) AS "Total Trips",
       CAST(COALESCE(a.zones, 0) AS BIGINT) AS "Number of Zones"
FROM cats c LEFT JOIN agg a ON c.cat = a.cat""",
    "filter_options": _with(_ZONES)
    + """
SELECT DISTINCT Borough, (SELECT MAX(number_of_trips) FROM loc) AS max_trips
FROM loc WHERE Borough IS NOT NULL""",
    "filtered_locations": _with(_ZONES)
    + """
SELECT PULocationID, Borough, Zone, number_of_trips, avg_trip_distance,
       format('{:,}', number_of_trips) AS number_of_trips_text,
       printf('%.2f', avg_trip_distance) AS avg_trip_distance_text
FROM loc WHERE Borough IN ('ASIA', 'EUROPE') AND number_of_trips >= 3""",
    "filtered_location_count": _with(_ZONES)
    + "\nSELECT COUNT(*) AS locations FROM loc WHERE Borough IN ('ASIA', 'EUROPE') AND number_of_trips >= 3",
    "checks_dimensions": _with(_ZONES, _SESSIONS.strip().rstrip(","))
    + """
SELECT 'unique' AS "check", 'LocationID' AS "column", 'fail' AS severity,
       CAST(COUNT(*) AS BIGINT) AS violations, COUNT(*) = 0 AS passed
FROM (SELECT LocationID FROM zones WHERE LocationID IS NOT NULL GROUP BY LocationID HAVING COUNT(*) > 1)
UNION ALL
SELECT 'unique', 'user_id', 'fail', CAST(COUNT(*) AS BIGINT), COUNT(*) = 0
FROM (SELECT user_id FROM users WHERE user_id IS NOT NULL GROUP BY user_id HAVING COUNT(*) > 1)
UNION ALL
SELECT 'is_floating', 'trip_miles', 'warn', CAST(typ NOT IN ('FLOAT', 'DOUBLE') AS BIGINT), typ IN ('FLOAT', 'DOUBLE')
FROM (SELECT any_value(typeof(trip_miles)) AS typ FROM tz)
UNION ALL
SELECT 'field_is', 'PULocationID', 'fail', CAST(typ <> 'BIGINT' AS BIGINT), typ = 'BIGINT'
FROM (SELECT any_value(typeof(PULocationID)) AS typ FROM tz)""",
    "override_types_roundtrip": """
SELECT l_orderkey, l_linenumber,
       CAST(l_quantity AS VARCHAR) AS l_quantity_text,
       CAST(l_extendedprice AS VARCHAR) AS l_extendedprice_text,
       CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS l_quantity,
       CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS l_extendedprice
FROM lineitem""",
    "write_audit_roundtrip": f"SELECT {LINEITEM_COLUMNS} FROM lineitem",
    "engagement_user_segments": _with(_ENGAGEMENT)
    + """
SELECT user_id, ROUND(user_engagement_score, 6) AS user_engagement_score,
       ROUND(daily_active_minutes_instagram, 6) AS daily_active_minutes_instagram,
       engagement_segment
FROM seg""",
    "engagement_segments": _with(_ENGAGEMENT)
    + """
SELECT engagement_segment, COUNT(*) AS users,
       ROUND(AVG(user_engagement_score), 6) AS avg_user_engagement_score,
       ROUND(AVG(daily_active_minutes_instagram), 6) AS avg_daily_active_minutes_instagram
FROM seg WHERE engagement_segment IS NOT NULL GROUP BY engagement_segment""",
    "conversion_kpis_text": _with(_SESSIONS)
    + f"""
SELECT format('{{:,}}', CAST(SUM(total_sessions) AS BIGINT)) AS total_sessions_text,
       format('{{:,}}', CAST(SUM(converting_sessions) AS BIGINT)) AS converting_sessions_text,
       printf('%.2f%%', 100.0 * SUM(converting_sessions) / SUM(total_sessions)) AS overall_rate_text,
       (SELECT customer_segment FROM cbs
        ORDER BY conversion_rate DESC, {_SEGMENT_RANK}, customer_segment LIMIT 1) AS best_segment
FROM cbs""",
    "segment_table": _with(_SESSIONS)
    + """
SELECT customer_segment AS "Segment", format('{:,}', total_sessions) AS "Sessions",
       format('{:,}', converting_sessions) AS "Conversions",
       printf('%.2f%%', conversion_rate * 100.0) AS "Conv. rate"
FROM cbs""",
    "borough_mix_top10": _with(_ZONES, _top(10))
    + "\nSELECT Borough, COUNT(*) AS count FROM top WHERE Borough IS NOT NULL GROUP BY Borough",
    "top_bars": _with(_ZONES, _top(20)) + "\nSELECT Zone, number_of_trips, avg_trip_distance, Borough FROM top",
    "top_pickup_locations_all_dates": _with(_ALL_ZONES) + f"\nSELECT * FROM loc {_ORDER}",
    "trip_statistics_all_dates": _with(_ALL_ZONES) + _STATISTICS,
    "borough_report_all_dates": _with(_ALL_ZONES) + _BOROUGHS,
    "distance_histogram_all_dates": _with(_ALL_ZONES) + _HISTOGRAM,
    "distance_categories_all_dates": _with(_ALL_ZONES) + _CATEGORIES,
    "price_quantiles": """
SELECT ROUND(quantile_cont(l_extendedprice, 0.1), 6) AS p10, ROUND(quantile_cont(l_extendedprice, 0.5), 6) AS median,
       ROUND(quantile_cont(l_extendedprice, 0.9), 6) AS p90
FROM lineitem""",
    "price_statistics": """
SELECT COUNT(l_quantity) AS count, ROUND(AVG(l_quantity), 6) AS mean, ROUND(MEDIAN(l_quantity), 6) AS median,
       ROUND(STDDEV_SAMP(l_quantity), 6) AS std, MIN(l_quantity) AS min, MAX(l_quantity) AS max
FROM lineitem""",
    "location_kpis_text": _with(_ZONES, _top(50))
    + f"""
SELECT format('{{:,}}', CAST(SUM(number_of_trips) AS BIGINT)) AS total_trips_text,
       format('{{:,.2f}}', AVG(avg_trip_distance)) AS avg_distance_text,
       (SELECT Zone FROM top {_ORDER} LIMIT 1) AS top_location,
       format('{{:,}}', MAX(number_of_trips)) AS top_location_trips_text
FROM top""",
    "trip_statistics_text": _with(_ZONES, _top(50))
    + """,
s AS (SELECT AVG(number_of_trips) AS a, MEDIAN(number_of_trips) AS b, STDDEV_SAMP(number_of_trips) AS c,
             MIN(number_of_trips)::DOUBLE AS d, MAX(number_of_trips)::DOUBLE AS e FROM top)
SELECT 'Mean Trips' AS "Metric", format('{:,.0f}', a) AS "Value" FROM s
UNION ALL SELECT 'Median Trips', format('{:,.0f}', b) FROM s
UNION ALL SELECT 'Std Dev Trips', format('{:,.0f}', c) FROM s
UNION ALL SELECT 'Min Trips', format('{:,.0f}', d) FROM s
UNION ALL SELECT 'Max Trips', format('{:,.0f}', e) FROM s""",
    "borough_report_text": _with(_ZONES, _top(50))
    + """
SELECT Borough, format('{:,}', CAST(SUM(number_of_trips) AS BIGINT)) AS "Total Trips",
       printf('%.2f', AVG(avg_trip_distance)) AS "Avg Distance",
       CAST(COUNT(Zone) AS VARCHAR) AS "Number of Zones"
FROM top WHERE Borough IS NOT NULL GROUP BY Borough""",
    "publish_roundtrip": "SELECT * FROM orders",
    "written_rows": "SELECT COUNT(*) AS rows FROM lineitem",
    "partitioned_roundtrip": """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN '007' ELSE '=' || l_returnflag END AS part
FROM lineitem""",
    "csv_roundtrip": """SELECT doc_id, '  "' || text || '", ' AS text, lang FROM documents""",
    "query_at_ref": """
SELECT l_returnflag, COUNT(*) AS lines, SUM(l_quantity) AS quantity
FROM lineitem WHERE l_linenumber > 1 GROUP BY l_returnflag""",
    "glob_mixed_types": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "detected_schema": """
SELECT 'l_orderkey' AS "column", 'bigint' AS type, COUNT(l_orderkey) AS n_values FROM lineitem
UNION ALL SELECT 'l_quantity', 'double', COUNT(l_quantity) FROM lineitem
UNION ALL SELECT 'l_returnflag', 'string', COUNT(l_returnflag) FROM lineitem
UNION ALL SELECT 'l_tax', 'double', COUNT(l_tax) FROM lineitem WHERE l_orderkey % 3 > 0""",
    "csv_records": """
SELECT doc_id, '  "' || text || '",' || chr(10) || ' ' || text AS text, lang FROM documents""",
    "query_plain_names": "SELECT COUNT(*) AS n FROM lineitem",
    "publish_versions": "SELECT * FROM orders",
    "read_as_of": """
SELECT o_orderkey, o_orderstatus, o_totalprice,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER) AS version
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "append_roundtrip": """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN '007' ELSE '=' || l_returnflag END AS part
FROM lineitem""",
    "incremental_conversion": _with(_SESSIONS) + "\nSELECT * FROM cbs",
    "incremental_locations": _with(_ALL_ZONES) + f"\nSELECT * FROM loc {_ORDER}",
    "clustered_trips": _with(_ZONES) + "\nSELECT * FROM tz",
    "copartitioned_trips": _with(_ZONES) + "\nSELECT * FROM tz",
    "sketched_price_quantiles": """
SELECT l_returnflag, p, COUNT(l_extendedprice) AS n, TRUE AS within
FROM lineitem, (SELECT UNNEST([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS p)
GROUP BY l_returnflag, p""",
    "ordered_export": _with(_ALL_ZONES)
    + f"""
SELECT PULocationID, Borough, Zone, number_of_trips, avg_trip_distance,
       ROW_NUMBER() OVER ({_ORDER}) AS position
FROM loc""",
}
