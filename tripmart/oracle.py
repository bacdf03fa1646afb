"""The products as plain SQL over the sample tables, to compare results with another engine.

Written step by step from the definitions and sharing nothing with the Spark plans: rules are separate
scans, summaries aggregate single trips, averages are exact integer divisions.
"""

from __future__ import annotations


def _mean(measure: str, count: str | None = None) -> str:
    """Exact mean of a non-negative amount, rounded half up to hundredths."""
    n = count or f"count({measure})"
    micros = f"cast(sum(cast({measure} AS decimal(18,6))) * 1000000 AS hugeint)"
    return f"cast(({micros} * 2 + {n} * 10000) // (2 * {n} * 10000) AS double) / 100"


def _total(measure: str) -> str:
    return f"cast(round(sum(cast({measure} AS decimal(18,6))), 2) AS double)"


def _whole_mean(total: str, count: str) -> str:
    return f"cast(({total} * 200 + {count}) // (2 * {count}) AS double) / 100"


_CTES = {
    "zones": """
        SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone, CAST(NULL AS varchar) AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw": """
        SELECT CAST(user_id % 2 + 1 AS integer) AS vendor_id,
               ts AS pickup, ts + to_seconds(CAST(trunc(value * 10) AS bigint) - 30) AS dropoff,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 7 AS double) / 2 END AS passenger_count,
               CAST(CASE WHEN event_id % 97 = 0 THEN 0.0 ELSE CAST(event_id % 50 + 1 AS double) / 10 END
                    AS decimal(18,6)) AS distance,
               CAST(event_id % 6 + 1 AS double) AS ratecode_id,
               CASE WHEN event_id % 100 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
               CAST(CASE WHEN event_id % 53 = 0 THEN 99 ELSE user_id % 24 END AS integer) AS pu,
               CAST((event_id * 7) % 26 AS integer) AS dol,
               CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 3
                               WHEN 'purchase' THEN 4 ELSE 0 END AS payment_type,
               CAST(CAST(value AS decimal(18,2)) - 2 AS decimal(18,6)) AS fare,
               CAST(event_id % 5 AS decimal(18,6)) AS tip,
               CAST(CAST(value AS decimal(18,2)) - 2 + event_id % 5 AS decimal(18,6)) AS total
        FROM events""",
    "issues": " UNION ALL ".join(
        f"SELECT '{code}' AS error_type, '{text}' AS description, pickup, dropoff, pu, dol, fare, total "
        f"FROM raw WHERE {rule}"
        for code, text, rule in (
            ("negative_fare", "the fare is negative", "fare < 0"),
            ("negative_total_amount", "the total charge is negative", "total < 0"),
            ("invalid_distance", "the distance is zero or negative", "distance <= 0"),
            ("invalid_datetime", "the trip does not end after it starts", "pickup >= dropoff"),
            ("unknown_payment_type", "the payment code is 0, which has no meaning", "payment_type = 0"),
        )
    ),
    "clean": """
        SELECT vendor_id, pickup, dropoff, CAST(pickup AS date) AS pickup_date,
               CAST(hour(pickup) AS integer) AS pickup_hour,
               rpad(dayname(pickup), 9, ' ') AS pickup_day_name,
               dayofweek(pickup) IN (0, 6) AS is_weekend,
               CASE WHEN hour(pickup) BETWEEN 5 AND 11 THEN 'Morning'
                    WHEN hour(pickup) BETWEEN 12 AND 16 THEN 'Afternoon'
                    WHEN hour(pickup) BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_period,
               CAST((2 * (epoch_us(dropoff) - epoch_us(pickup)) + 600000) // 1200000 AS decimal(12,0)) * 0.01 AS minutes,
               CAST(round(passenger_count, 0) AS integer) AS passenger_count, distance, pu, dol,
               CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
                                 WHEN 4 THEN 'Dispute' ELSE 'Unknown' END AS label,
               fare, tip, total
        FROM raw
        WHERE fare >= 0 AND total >= 0 AND distance > 0 AND pickup < dropoff
          AND pu IN (SELECT location_id FROM zones) AND dol IN (SELECT location_id FROM zones)""",
    "daily": f"""
        SELECT pickup_date, count(*) AS total_trips, {_total("total")} AS total_revenue, {_mean("fare")} AS avg_fare,
               {_mean("distance")} AS avg_distance, {_mean("minutes")} AS avg_duration_minutes
        FROM clean GROUP BY pickup_date""",
    "hourly": f"""
        SELECT pickup_hour, count(*) AS total_trips, {_total("total")} AS total_revenue, {_mean("fare")} AS avg_fare,
               {_mean("minutes")} AS avg_duration_minutes
        FROM clean GROUP BY pickup_hour""",
    "payments": f"""
        SELECT label AS payment_type_label, count(*) AS total_trips, {_total("total")} AS total_revenue,
               {_mean("fare")} AS avg_fare, {_mean("tip")} AS avg_tip,
               {_whole_mean("count(*) * 100", "(SELECT count(*) FROM clean)")} AS pct_of_total_trips
        FROM clean GROUP BY label""",
    "pickups": f"""
        SELECT pu, count(*) AS trips, {_total("total")} AS revenue, {_mean("fare")} AS avg_fare,
               {_mean("tip")} AS avg_tip
        FROM clean GROUP BY pu""",
    "dropoffs": "SELECT dol, count(*) AS trips FROM clean GROUP BY dol",
    "zone_performance": """
        SELECT location_id, borough, zone, coalesce(p.trips, 0) AS total_pickup_trips,
               coalesce(d.trips, 0) AS total_dropoff_trips, coalesce(p.revenue, 0) AS total_revenue,
               p.avg_fare, p.avg_tip
        FROM zones LEFT JOIN pickups p ON location_id = p.pu LEFT JOIN dropoffs d ON location_id = d.dol""",
    "enriched": """
        SELECT c.*, p.borough AS pickup_borough, p.zone AS pickup_zone, d.borough AS dropoff_borough,
               d.zone AS dropoff_zone
        FROM clean c JOIN zones p ON pu = p.location_id JOIN zones d ON dol = d.location_id""",
    "routes": f"""
        SELECT pickup_zone, dropoff_zone, pickup_borough, dropoff_borough, count(*) AS total_trips,
               {_total("total")} AS total_revenue, {_mean("fare")} AS avg_fare
        FROM enriched GROUP BY ALL
        ORDER BY total_trips DESC, pickup_zone, dropoff_zone, pickup_borough, dropoff_borough LIMIT 1000""",
}

_PREFIX = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items())

_TRIP = """vendor_id, CAST(pickup AS varchar) AS pickup_datetime, CAST(dropoff AS varchar) AS dropoff_datetime,
    CAST(pickup_date AS varchar) AS pickup_date, pickup_hour, pickup_day_name, is_weekend, time_period,
    CAST(minutes AS double) AS trip_duration_minutes, passenger_count, CAST(distance AS double) AS trip_distance,
    pu AS pickup_location_id, dol AS dropoff_location_id, label AS payment_type_label,
    CAST(fare AS double) AS fare_amount, CAST(tip AS double) AS tip_amount, CAST(total AS double) AS total_amount"""

_DAY = "CAST(pickup_date AS varchar) AS pickup_date"

_SUMS = """count(*) AS trips, CAST(sum(total) AS double) AS revenue, CAST(sum(fare) AS double) AS fare,
    CAST(sum(tip) AS double) AS tip, count(tip) AS tipped_trips"""


def _never_broken(table: str, rules: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) FILTER ({test}) AS violations FROM {source}"
        for rule, test in rules
    )


def _trip_rules() -> list[tuple[str, str]]:
    column = {
        "pickup_datetime": "pickup", "dropoff_datetime": "dropoff", "trip_duration_minutes": "minutes",
        "trip_distance": "distance", "fare_amount": "fare", "tip_amount": "tip", "total_amount": "total",
    }
    missing = [
        "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour", "pickup_day_name",
        "is_weekend", "time_period", "trip_duration_minutes", "trip_distance", "fare_amount", "tip_amount",
        "total_amount",
    ]
    negative = ["trip_duration_minutes", "trip_distance", "fare_amount", "tip_amount", "total_amount"]
    return (
        [(f"{name} is missing", "false" if name == "trip_id" else f"{column.get(name, name)} IS NULL")
         for name in missing]
        + [(f"{name} is negative", f"{column[name]} < 0") for name in negative]
        + [("pickup_hour is outside 0..23", "pickup_hour NOT BETWEEN 0 AND 23")]
    )


_SELECTS = {
    "bronze_trips": """
        SELECT vendor_id, CAST(pickup AS varchar) AS tpep_pickup_datetime,
               CAST(dropoff AS varchar) AS tpep_dropoff_datetime, passenger_count,
               CAST(distance AS double) AS trip_distance, ratecode_id, store_and_fwd_flag, pu AS pulocation_id,
               dol AS dolocation_id, CAST(payment_type AS double) AS payment_type, CAST(fare AS double) AS fare_amount,
               0.5::double AS extra, 0.5::double AS mta_tax, CAST(tip AS double) AS tip_amount,
               0::double AS tolls_amount, 1::double AS improvement_surcharge, CAST(total AS double) AS total_amount,
               2.5::double AS congestion_surcharge, 0::double AS airport_fee, 0.75::double AS cbd_congestion_fee,
               'events.parquet' AS source_file
        FROM raw""",
    "bronze_zones": """
        SELECT location_id AS locationid, borough, zone, service_zone, 'nation.parquet' AS source_file FROM zones""",
    "csv_documents": """
        SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars, md5(nullif(text, '')) AS text_md5
        FROM documents""",
    "integrity_generated_keys": """
        SELECT * FROM (
            SELECT file, n, low, high, max(high) OVER (ORDER BY low, file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
            FROM (SELECT event_id // 1000 + CAST(event_id % 997 = 5 AS bigint) AS file, count(*) AS n, min(event_id) AS low,
                         max(event_id) AS high FROM events GROUP BY 1))
        WHERE low <= reached OR high - low + 1 < n""",
    "silver_dense_ids": """
        SELECT n, 1 AS first, n AS last, n AS ids, CAST(n * (n + 1) / 2 AS bigint) AS total
        FROM (SELECT count(*) AS n FROM issues)""",
    "silver_zones": "SELECT location_id, borough, zone, service_zone FROM zones",
    "silver_trips": f"SELECT {_TRIP} FROM clean",
    "silver_trips_of_a_zone": f"""
        SELECT {_TRIP}, 'pickup_location_id' AS looked_up FROM clean WHERE pu = 7
        UNION ALL SELECT {_TRIP}, 'dropoff_location_id' FROM clean WHERE dol = 7""",
    "silver_issues": """
        SELECT error_type, description, CAST(pickup AS varchar) AS pickup_datetime,
               CAST(dropoff AS varchar) AS dropoff_datetime, pu AS pulocation_id, dol AS dolocation_id,
               CAST(fare AS double) AS fare_amount, CAST(total AS double) AS total_amount,
               CAST(NULL AS varchar) AS raw_row_ref
        FROM issues""",
    "integrity_trips": _never_broken("silver.taxi_trips_cleaned", _trip_rules(), "clean"),
    "integrity_duplicate_keys": """
        SELECT 'silver.taxi_zones' AS table_name, '{"location_id":' || location_id || '}' AS key,
               count(*) AS occurrences
        FROM zones GROUP BY location_id HAVING count(*) > 1""",
    "integrity_unknown_locations": """
        SELECT DISTINCT location_id
        FROM (SELECT pu AS location_id FROM raw UNION ALL SELECT dol FROM raw)
        WHERE location_id NOT IN (SELECT location_id FROM zones)""",
    "rollup_by_time": f"""
        SELECT {_DAY}, pickup_hour, label AS payment_type_label, {_SUMS},
               CAST(sum(distance) AS double) AS distance, CAST(sum(minutes) AS double) AS minutes
        FROM clean GROUP BY clean.pickup_date, pickup_hour, label""",
    "rollup_by_route": f"""
        SELECT pu AS pickup_location_id, dol AS dropoff_location_id, {_SUMS} FROM clean GROUP BY pu, dol""",
    "gold_daily_summary": f"SELECT * REPLACE ({_DAY}) FROM daily",
    "gold_hourly_demand": "SELECT * FROM hourly",
    "gold_zone_performance": "SELECT * FROM zone_performance",
    "gold_payment_behavior": "SELECT * FROM payments",
    "gold_route_performance": "SELECT * FROM routes",
    "view_trip_enriched": f"SELECT {_TRIP}, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone FROM enriched",
    "view_daily_trends": f"""
        SELECT * REPLACE ({_DAY}),
               CAST(sum(CAST(total_revenue AS decimal(18,2))) OVER (ORDER BY daily.pickup_date ROWS UNBOUNDED PRECEDING)
                    AS double) AS running_total_revenue,
               {_whole_mean("(sum(total_trips) OVER w)::hugeint", "(count(*) OVER w)")} AS moving_avg_7d_trips,
               lag(total_revenue) OVER (ORDER BY daily.pickup_date) AS prev_day_revenue,
               CAST(CAST(total_revenue AS decimal(18,2))
                    - lag(CAST(total_revenue AS decimal(18,2))) OVER (ORDER BY daily.pickup_date) AS double)
                    AS revenue_diff_prev_day
        FROM daily WINDOW w AS (ORDER BY daily.pickup_date ROWS 6 PRECEDING)""",
    "view_zone_ranks": """
        SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
               rank() OVER (PARTITION BY borough ORDER BY total_revenue DESC) AS revenue_rank_in_borough
        FROM zone_performance""",
    "q1_valid_trip_count": "SELECT count(*) AS total_valid_trips FROM clean",
    "q2_revenue_summary": f"""
        SELECT {_total("total")} AS total_revenue, {_mean("total")} AS avg_revenue, {_mean("fare")} AS avg_fare,
               {_mean("tip")} AS avg_tip
        FROM clean""",
    "q5_payment_types": "SELECT payment_type_label, total_trips, total_revenue, pct_of_total_trips FROM payments",
    "q6_busiest_boroughs": "SELECT pickup_borough, count(*) AS total_trips FROM enriched GROUP BY pickup_borough",
    "q6_busiest_zones": """
        SELECT pickup_zone, pickup_borough, count(*) AS total_trips FROM enriched
        GROUP BY pickup_zone, pickup_borough ORDER BY total_trips DESC, pickup_zone, pickup_borough LIMIT 10""",
    "q7_top_revenue_zones": """
        SELECT zone, borough, total_revenue, avg_fare, avg_tip, total_pickup_trips FROM zone_performance
        ORDER BY total_revenue DESC, location_id LIMIT 10""",
    "q7_written_report": """
        SELECT zone, borough, total_revenue, avg_fare, total_pickup_trips FROM zone_performance
        ORDER BY total_revenue DESC, location_id LIMIT 10""",
    "q8_top_routes": """
        SELECT pickup_zone, dropoff_zone, pickup_borough, dropoff_borough, total_trips, total_revenue FROM routes
        ORDER BY total_trips DESC, pickup_zone, dropoff_zone, pickup_borough, dropoff_borough LIMIT 10""",
    "q10_issue_counts": "SELECT error_type, count(*) AS total_issues FROM issues GROUP BY error_type",
    "q13_top_pickup_zones": """
        SELECT zone, borough, revenue AS total_revenue, trips AS total_trips, avg_tip
        FROM pickups JOIN zones ON pu = location_id ORDER BY revenue DESC, location_id LIMIT 10""",
    "q18_zone_revenue_ranking": """
        SELECT zone, borough, total_revenue, total_pickup_trips,
               rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
               dense_rank() OVER (ORDER BY total_revenue DESC) AS revenue_dense_rank
        FROM zone_performance ORDER BY revenue_rank, location_id LIMIT 20""",
    "q18_written_report": """
        SELECT zone, borough, total_revenue, total_pickup_trips,
               rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank
        FROM zone_performance ORDER BY revenue_rank, location_id LIMIT 20""",
    "q19_zone_ranking_in_borough": """
        SELECT borough, zone, total_revenue, total_pickup_trips,
               rank() OVER (PARTITION BY borough ORDER BY total_revenue DESC) AS rank_in_borough
        FROM zone_performance ORDER BY borough, rank_in_borough, location_id LIMIT 30""",
    "markdown_zone_performance": """
        SELECT '| ' || location_id || ' | ' || borough || ' | ' || zone || ' | ' || total_pickup_trips || ' | '
               || total_dropoff_trips || ' | ' || CAST(total_revenue AS decimal(28,2)) || ' | '
               || coalesce(CAST(CAST(avg_fare AS decimal(20,2)) AS varchar), '') || ' | '
               || coalesce(CAST(CAST(avg_tip AS decimal(20,2)) AS varchar), '') || ' |' AS value
        FROM zone_performance""",
}

_ROUTE_ORDER = "total_trips DESC, pickup_zone, dropoff_zone, pickup_borough, dropoff_borough"


def _placed(columns: str, source: str, order: str, limit: int | None = None) -> str:
    """Rows with their position in an order, up to a limit."""
    placed = f"SELECT {columns}, row_number() OVER (ORDER BY {order}) AS position FROM {source}"
    return placed if limit is None else f"SELECT * FROM ({placed}) WHERE position <= {limit}"


_RANKED = """(SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
    dense_rank() OVER (ORDER BY total_revenue DESC) AS revenue_dense_rank,
    rank() OVER (PARTITION BY borough ORDER BY total_revenue DESC) AS rank_in_borough FROM zone_performance)"""
_IN_BOROUGH = ("borough, zone, total_revenue, total_pickup_trips, rank_in_borough", _RANKED,
               "borough, rank_in_borough, location_id")
_REVENUE_ORDER = "total_revenue DESC, location_id"

_SELECTS |= {
    "integrity_raw_trips": _never_broken("bronze.raw_taxi_trips", [
        ("passenger_count is missing", "passenger_count IS NULL"), ("tpep_pickup_datetime is missing", "pickup IS NULL"),
        ("fare_amount is negative", "fare < 0"), ("total_amount is negative", "total < 0"),
        ("pulocation_id is outside 0..24", "pu NOT BETWEEN 0 AND 24"),
        ("payment_type is outside 1..4", "payment_type NOT BETWEEN 1 AND 4"),
    ], "raw"),
    "integrity_repeated_routes": """
        SELECT 'bronze.raw_taxi_trips' AS table_name,
               '{"pulocation_id":' || coalesce(pu::varchar, 'null') || ',"dolocation_id":' || coalesce(dol::varchar, 'null')
               || '}' AS key, count(*) AS occurrences
        FROM raw GROUP BY pu, dol HAVING count(*) > 1""",
    "markdown_report": """
        SELECT value, row_number() OVER (ORDER BY part, place) AS position FROM (
            SELECT 0 AS part, 1 AS place, '# payment types' AS value UNION ALL SELECT 0, 2, ''
            UNION ALL SELECT 0, 3, '*Run at: 2024-02-01 00:00:00*' UNION ALL SELECT 0, 4, ''
            UNION ALL SELECT 0, 5, '| payment_type_label | total_trips | total_revenue | pct_of_total_trips |'
            UNION ALL SELECT 0, 6, '| --- | --- | --- | --- |'
            UNION ALL SELECT 1, row_number() OVER (ORDER BY total_trips DESC, payment_type_label),
                   '| ' || payment_type_label || ' | ' || total_trips || ' | ' || CAST(total_revenue AS decimal(28,2))
                   || ' | ' || CAST(pct_of_total_trips AS decimal(20,2)) || ' |' FROM payments
            UNION ALL SELECT 2, 1, '' UNION ALL SELECT 2, 2, '*Total: ' || count(*) || ' rows*' FROM payments)""",
    "gold_first_300_routes": _placed("*", "routes", _ROUTE_ORDER, 300),
    "q19_first_12_in_order": _placed(*_IN_BOROUGH, 12),
    "q5_in_order": _placed("payment_type_label, total_trips, total_revenue, pct_of_total_trips", "payments",
                           "total_trips DESC, payment_type_label"),
    "q6_boroughs_in_order": _placed(
        "*", "(SELECT pickup_borough, count(*) AS total_trips FROM enriched GROUP BY pickup_borough)",
        "total_trips DESC, pickup_borough"),
    "q6_zones_in_order": _placed(
        "*", "(SELECT pickup_zone, pickup_borough, count(*) AS total_trips FROM enriched GROUP BY ALL)",
        "total_trips DESC, pickup_zone, pickup_borough", 10),
    "q7_in_order": _placed("zone, borough, total_revenue, avg_fare, avg_tip, total_pickup_trips", "zone_performance",
                           _REVENUE_ORDER, 10),
    "q8_in_order": _placed("pickup_zone, dropoff_zone, pickup_borough, dropoff_borough, total_trips, total_revenue",
                           "routes", _ROUTE_ORDER, 10),
    "q10_in_order": _placed("*", "(SELECT error_type, count(*) AS total_issues FROM issues GROUP BY error_type)",
                            "total_issues DESC, error_type"),
    "q13_in_order": _placed("zone, borough, revenue AS total_revenue, trips AS total_trips, avg_tip",
                            "pickups JOIN zones ON pu = location_id", "revenue DESC, location_id", 10),
    "q18_in_order": _placed("zone, borough, total_revenue, total_pickup_trips, revenue_rank, revenue_dense_rank",
                            _RANKED, "revenue_rank, location_id", 20),
    "q19_in_order": _placed(*_IN_BOROUGH, 30),
    "audit_states": """
        SELECT audit_id, layer, table_name, process_name, status, row_count, CAST(started_at AS varchar) AS started_at,
               CAST(finished_at AS varchar) AS finished_at, error_message
        FROM (SELECT event_id % 700 AS audit_id, 'silver' AS layer, event_type AS table_name, 'load' AS process_name,
                     CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status,
                     CASE event_type WHEN 'purchase' THEN user_id END AS row_count, ts AS started_at,
                     CASE WHEN event_type IN ('purchase', 'error') THEN ts END AS finished_at,
                     CASE event_type WHEN 'error' THEN 'event ' || event_id END AS error_message,
                     row_number() OVER (PARTITION BY event_id % 700
                                        ORDER BY event_type IN ('purchase', 'error') DESC, event_id DESC) AS nth
              FROM events)
        WHERE nth = 1""",
}


def oracle_queries() -> dict[str, str]:
    return {name: f"{_PREFIX}\n{select}" for name, select in _SELECTS.items()}
