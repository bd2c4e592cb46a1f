"""The same queries as SQL text for DuckDB, written against the supplied tables alone.

Relations are named common table expressions; a query lists the ones it needs
and the text before it brings in what those depend on.
"""


def _checks(source: str) -> str:
    """Failing rows per rule; a comparison with NULL counts nothing."""
    return f"""
        SELECT count(*) FILTER (pickup_location_id IS NULL OR dropoff_location_id IS NULL) AS null_key_identifiers,
               count(*) FILTER (payment_type NOT IN (1, 2, 3, 4, 5, 6)) AS payment_type_accepted,
               count(*) FILTER (rate_code_id NOT IN (1, 2, 3, 4, 5, 6, 99)) AS rate_code_accepted,
               count(*) FILTER (pickup_ts >= dropoff_ts) AS timestamps_valid,
               count(*) FILTER (fare_amount < 0 OR trip_distance < 0) AS non_negative_fare_distance,
               count(*) FILTER (pickup_zone IS NULL OR dropoff_zone IS NULL) AS zone_integrity,
               count(*) FILTER (trip_duration_minutes <= 0 OR trip_duration_minutes > 480 OR trip_speed_mph > 80)
                   AS duration_speed_anomaly
        FROM {source}
        """


# relation -> (relations it reads, SQL)
_RELATIONS: dict[str, tuple[list[str], str]] = {
    "raw": (
        [],
        """
        SELECT CAST(l_linenumber % 2 + 1 AS BIGINT) AS "VendorID",
               o_orderdate + to_seconds(off_s) AS tpep_pickup_datetime,
               o_orderdate + to_seconds(off_s + dur_s) AS tpep_dropoff_datetime,
               CAST(CAST(l_quantity AS BIGINT) % 6 + 1 AS DOUBLE) AS passenger_count,
               (CASE WHEN l_partkey % 101 = 0 THEN -1e0 ELSE 1e0 END) * l_quantity / 4e0 AS trip_distance,
               CAST(CASE WHEN l_suppkey % 50 = 7 THEN 7
                         ELSE CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 99 END END AS DOUBLE)
                   AS "RatecodeID",
               CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS "PULocationID",
               CAST(s_nationkey AS BIGINT) AS "DOLocationID",
               CASE WHEN l_orderkey % 307 = 0 THEN NULL
                    WHEN o_orderstatus = 'P' AND l_linenumber = 7 THEN 0
                    ELSE CAST(left(o_orderpriority, 1) AS BIGINT) END AS payment_type,
               (CASE WHEN l_partkey % 103 = 0 THEN -1e0 ELSE 1e0 END) * round(l_extendedprice / 1000, 2)
                   AS fare_amount,
               (l_linenumber % 3) * 0.5e0 AS extra,
               0.5e0 AS mta_tax,
               l_discount AS tip_amount,
               l_tax AS tolls_amount,
               0.3e0 AS improvement_surcharge,
               round(l_extendedprice / 1000 * (1 + l_tax), 2) AS total_amount,
               2.5e0 AS congestion_surcharge,
               0e0 AS "Airport_fee",
               l_linenumber,
               strftime(o_orderdate + to_seconds(off_s + dur_s), '%Y-%m') AS file_month
        FROM (SELECT *, (l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS off_s,
                     (CASE WHEN l_partkey % 97 = 0 THEN 30000 ELSE 0 END)
                         + (l_partkey * 31 + l_suppkey * 17) % 5400 - 60 AS dur_s
              FROM lineitem)
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        """,
    ),
    "bronze": (
        ["raw"],
        """
        SELECT *, 'trips' AS source_name, 'b1' AS batch_id FROM raw
        UNION ALL
        SELECT * REPLACE (total_amount + 1e0 AS total_amount), 'trips', 'b2' FROM raw WHERE l_linenumber = 1
        """,
    ),
    "zones_raw": (
        [],
        """
        SELECT CAST(n_nationkey AS VARCHAR) AS "LocationID", r_name AS "Borough", n_name AS "Zone",
               'Z' || n_regionkey AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24
        UNION ALL
        SELECT '3', r_name, 'NATION_3_OLD', 'Z' || n_regionkey
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 3
        """,
    ),
    "zones": (
        ["zones_raw"],
        """
        SELECT location_id, borough, zone, service_zone FROM (
            SELECT CAST("LocationID" AS INTEGER) AS location_id, "Borough" AS borough, "Zone" AS zone, service_zone,
                   row_number() OVER (PARTITION BY "LocationID" ORDER BY "Borough", "Zone", service_zone) AS copy
            FROM zones_raw) WHERE copy = 1
        """,
    ),
    "typed": (
        ["bronze"],
        """
        SELECT tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
               CAST("VendorID" AS INTEGER) AS vendor_id, CAST("RatecodeID" AS INTEGER) AS rate_code_id,
               CAST("PULocationID" AS INTEGER) AS pickup_location_id,
               CAST("DOLocationID" AS INTEGER) AS dropoff_location_id,
               CAST(payment_type AS INTEGER) AS payment_type, CAST(passenger_count AS INTEGER) AS passenger_count,
               trip_distance, fare_amount, total_amount, extra, mta_tax, tip_amount, tolls_amount,
               improvement_surcharge, congestion_surcharge, "Airport_fee", source_name, batch_id
        FROM bronze
        """,
    ),
    "measured": (
        ["typed"],
        """
        SELECT *, CASE WHEN trip_duration_minutes > 0 THEN trip_distance / (trip_duration_minutes / 60e0) END
                   AS trip_speed_mph
        FROM (SELECT *, date_diff('second', pickup_ts, dropoff_ts) / 60e0 AS trip_duration_minutes FROM typed)
        """,
    ),
    "deduped": (
        ["measured"],
        """
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY pickup_ts, dropoff_ts, pickup_location_id, dropoff_location_id, fare_amount, trip_distance
                ORDER BY batch_id DESC, total_amount DESC, payment_type NULLS LAST, rate_code_id NULLS LAST,
                         vendor_id NULLS LAST, passenger_count NULLS LAST) AS copy
            FROM measured) WHERE copy = 1
        """,
    ),
    "enriched": (
        ["deduped", "zones"],
        """
        SELECT d.*, strftime(pickup_ts, '%Y-%m') AS pickup_month,
               p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
               q.borough AS dropoff_borough, q.zone AS dropoff_zone, q.service_zone AS dropoff_service_zone
        FROM deduped d LEFT JOIN zones p ON pickup_location_id = p.location_id
        LEFT JOIN zones q ON dropoff_location_id = q.location_id
        """,
    ),
    "silver": (
        ["enriched"],
        """
        SELECT * FROM enriched
        WHERE pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
          AND payment_type BETWEEN 1 AND 6 AND (rate_code_id BETWEEN 1 AND 6 OR rate_code_id = 99)
          AND pickup_ts < dropoff_ts AND fare_amount >= 0 AND trip_distance >= 0
          AND pickup_zone IS NOT NULL AND dropoff_zone IS NOT NULL
          AND trip_duration_minutes > 0 AND trip_duration_minutes <= 480 AND trip_speed_mph <= 80
        """,
    ),
    "fact": (
        ["silver"],
        """
        SELECT *, CAST(pickup_ts AS DATE) AS trip_date, CAST(hour(pickup_ts) AS INTEGER) AS trip_hour,
               pickup_month AS trip_month
        FROM silver
        """,
    ),
    "demand": (
        ["fact"],
        """
        SELECT trip_date, trip_hour, trip_month, pickup_location_id, pickup_borough, pickup_zone,
               count(*) AS pickup_trip_count, CAST(sum(passenger_count) AS BIGINT) AS passenger_total
        FROM fact GROUP BY ALL
        """,
    ),
    "revenue": (
        ["fact"],
        """
        SELECT trip_date, trip_month, pickup_borough,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS daily_revenue,
               CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS daily_fare, count(*) AS trip_count
        FROM fact GROUP BY ALL
        """,
    ),
    "airport": (
        ["fact"],
        """
        SELECT trip_month, pickup_zone, dropoff_zone, count(*) AS trip_count,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM fact
        WHERE pickup_zone IN ('NATION_3', 'NATION_7', 'NATION_11')
           OR dropoff_zone IN ('NATION_3', 'NATION_7', 'NATION_11')
        GROUP BY ALL
        """,
    ),
    "payment": (
        ["fact"],
        """
        SELECT trip_date, trip_month, pickup_borough, payment_type, count(*) AS trip_count,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
        FROM fact GROUP BY ALL
        """,
    ),
    "efficiency": (
        ["fact"],
        """
        SELECT pickup_borough, round(avg(trip_distance), 4) AS avg_trip_distance,
               round(avg(trip_duration_minutes), 4) AS avg_trip_duration_minutes,
               round(avg(fare_amount / CASE WHEN trip_distance > 0 THEN trip_distance END), 4) AS avg_fare_per_mile,
               round(avg(fare_amount / CASE WHEN trip_duration_minutes > 0 THEN trip_duration_minutes END), 4)
                   AS avg_fare_per_minute
        FROM fact GROUP BY pickup_borough
        """,
    ),
    "zone_daily": (
        ["demand"],
        """
        SELECT trip_date, pickup_zone, CAST(sum(pickup_trip_count) AS BIGINT) AS pickups
        FROM demand GROUP BY ALL
        """,
    ),
    "zone_stats": (
        ["zone_daily"],
        """
        SELECT pickup_zone, avg(pickups) AS avg_pickups, stddev_pop(pickups) AS std_pickups
        FROM zone_daily GROUP BY pickup_zone
        """,
    ),
    "checks": (["enriched"], _checks("enriched")),
    "silver_checks": (["silver"], _checks("silver")),
    "requested": (
        ["raw"],
        """
        SELECT strftime(first_day, '%Y-%m') AS month FROM (
            SELECT unnest(generate_series(min(CAST(file_month || '-01' AS DATE)),
                                          max(CAST(file_month || '-01' AS DATE)), INTERVAL 1 MONTH)) AS first_day
            FROM raw)
        """,
    ),
    "done": (["raw"], "SELECT DISTINCT file_month AS month FROM raw WHERE file_month < '1998-01'"),
}


def _with(relations: list[str], body: str, replaced: dict[str, tuple[list[str], str]] | None = None) -> str:
    """The body behind the definitions of the relations it reads, dependencies first."""
    known = {**_RELATIONS, **(replaced or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in known[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in relations:
        visit(name)
    ctes = ",\n".join(f"{name} AS ({known[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body


_RAW_COLUMNS = """
    "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "RatecodeID",
    "PULocationID", "DOLocationID", payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount, congestion_surcharge, "Airport_fee"
"""
_TRIP_ID = "pickup_ts, dropoff_ts, pickup_location_id, dropoff_location_id, fare_amount, trip_distance"
_FILTER_MONTHS = "('1995-03', '1995-04', '1997-11')"
_FILE_FEE = """CASE WHEN file_month < '1998-01' THEN NULL ELSE "Airport_fee" END"""

# rule name -> the opposite of keeping a row, NULL included
_REJECTED = {
    "null_key_identifiers": "pickup_location_id IS NULL OR dropoff_location_id IS NULL",
    "payment_type_accepted": "payment_type IS NULL OR payment_type NOT IN (1, 2, 3, 4, 5, 6)",
    "rate_code_accepted": "rate_code_id IS NULL OR rate_code_id NOT IN (1, 2, 3, 4, 5, 6, 99)",
    "timestamps_valid": "pickup_ts >= dropoff_ts",
    "non_negative_fare_distance": "fare_amount < 0 OR trip_distance < 0",
    "zone_integrity": "pickup_zone IS NULL OR dropoff_zone IS NULL",
    "duration_speed_anomaly": "trip_duration_minutes <= 0 OR trip_duration_minutes > 480 OR trip_speed_mph > 80 "
    "OR trip_speed_mph IS NULL",
}


def _quarantine() -> str:
    counts = [
        f"SELECT '{rule}' AS rule, count(*) AS row_count FROM enriched WHERE {test}"
        for rule, test in _REJECTED.items()
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(counts) + ") WHERE row_count > 0"


def _check_rows(source: str) -> str:
    return f"""
        SELECT check_name, failed_rows, failed_rows = 0 AS passed
        FROM (UNPIVOT {source} ON COLUMNS(*) INTO NAME check_name VALUE failed_rows)
    """


# query -> (relations, SQL body)
_QUERIES: dict[str, tuple[list[str], str]] = {
    "scan_monthly_parquet": (
        ["raw"],
        f"""
        SELECT file_month, count(*) AS trip_count,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
               CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fare_amount,
               count({_FILE_FEE}) AS airport_fee_rows
        FROM raw GROUP BY file_month
        """,
    ),
    "schema_evolution_union": (
        ["raw"],
        f"""
        SELECT "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, total_amount, {_FILE_FEE} AS "Airport_fee"
        FROM raw
        """,
    ),
    "bronze_trips_metadata": (
        ["raw"],
        """
        SELECT tpep_pickup_datetime, total_amount, 'trips' AS source_name, 'b1' AS batch_id,
               'file_month=' || file_month AS source_folder, TRUE AS is_stamped
        FROM raw
        """,
    ),
    "scan_zone_csv": (["zones_raw"], "SELECT * FROM zones_raw"),
    "sql_over_views": (
        ["revenue"],
        """
        SELECT CAST(date_trunc('month', trip_date) AS DATE) AS revenue_month, pickup_borough,
               CAST(sum(trip_count) AS BIGINT) AS trip_count, round(sum(daily_revenue), 2) AS monthly_revenue
        FROM revenue GROUP BY 1, 2
        """,
    ),
    "month_range": (
        ["typed"],
        """
        SELECT pickup_location_id, strftime(first_day, '%Y-%m') AS month FROM (
            SELECT pickup_location_id, unnest(generate_series(
                       CAST(date_trunc('month', min(pickup_ts)) AS DATE),
                       CAST(date_trunc('month', max(pickup_ts)) AS DATE), INTERVAL 1 MONTH)) AS first_day
            FROM typed GROUP BY pickup_location_id)
        """,
    ),
    "incremental_months_todo": (["requested", "done"], "SELECT month FROM requested EXCEPT SELECT month FROM done"),
    "incremental_manifest_after": (
        ["requested", "done"],
        "SELECT month FROM requested UNION SELECT month FROM done",
    ),
    "sink_append_batches": (
        ["bronze"],
        """
        SELECT CASE batch_id WHEN 'b1' THEN '20240101000000' ELSE '20240201000000' END AS batch_id, payment_type,
               count(*) AS trip_count, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
        FROM bronze GROUP BY ALL
        """,
    ),
    "revenue_of_fine_amounts": (
        [],
        """
        SELECT l_returnflag, l_linestatus,
               round(CAST(sum(CASE WHEN NOT huge THEN CAST(amount AS DECIMAL(28,10)) END) AS DOUBLE)
                     + coalesce(sum(CASE WHEN huge THEN 1e20 END), 0), 4) AS revenue,
               round((CAST(sum(CASE WHEN NOT huge THEN CAST(amount AS DECIMAL(28,10)) END) AS DOUBLE)
                      + coalesce(sum(CASE WHEN huge THEN 1e20 END), 0)) / count(*), 4) AS average
        FROM (SELECT l_returnflag, l_linestatus, l_extendedprice * (1 - l_discount) / 1000 AS amount,
                     l_orderkey % 1000 = 0 AND l_linestatus = 'F' AS huge FROM lineitem)
        GROUP BY l_returnflag, l_linestatus
        """,
    ),
    "bronze_with_added_column": (
        ["bronze"],
        """
        SELECT batch_id, tpep_pickup_datetime, total_amount,
               CASE batch_id WHEN 'b2' THEN total_amount / 8 END AS cbd_congestion_fee
        FROM bronze
        """,
    ),
    "sink_full_overwrite": (["zones"], "SELECT * FROM zones"),
    "sink_dynamic_overwrite": (
        ["demand"],
        """
        SELECT * REPLACE (pickup_trip_count + CASE WHEN trip_month >= '1998-01' THEN 100 ELSE 0 END
                          AS pickup_trip_count)
        FROM demand WHERE trip_month <> '1996-05'
        """,
    ),
    "project_bronze_columns": (["bronze"], f"SELECT {_RAW_COLUMNS}, source_name, batch_id FROM bronze"),
    "cast_normalize_trips": (
        ["typed"],
        f"""
        SELECT {_TRIP_ID}, vendor_id, rate_code_id, payment_type, passenger_count, total_amount, batch_id FROM typed
        """,
    ),
    "fact_date_parts": (
        ["fact"],
        "SELECT pickup_ts, dropoff_ts, pickup_location_id, trip_date, trip_hour, trip_month FROM fact",
    ),
    "trip_duration_speed": (
        ["measured"],
        "SELECT pickup_ts, dropoff_ts, trip_distance, trip_duration_minutes, trip_speed_mph FROM measured",
    ),
    "zones_silver": (["zones"], "SELECT * FROM zones"),
    "dedup_zones": (["zones"], "SELECT location_id, borough, zone FROM zones"),
    "dim_zones": (["zones"], "SELECT * FROM zones"),
    "zone_roles": (
        ["zones"],
        """
        SELECT location_id AS pickup_location_id, borough AS pickup_borough, zone AS pickup_zone,
               service_zone AS pickup_service_zone, location_id AS dropoff_location_id, borough AS dropoff_borough,
               zone AS dropoff_zone, service_zone AS dropoff_service_zone
        FROM zones
        """,
    ),
    "filter_run_months": (
        ["bronze"],
        f"""
        SELECT tpep_pickup_datetime, "PULocationID", "DOLocationID", total_amount, batch_id
        FROM bronze WHERE strftime(tpep_pickup_datetime, '%Y-%m') IN {_FILTER_MONTHS}
        """,
    ),
    "filter_partition_months": (
        ["silver"],
        f"""
        SELECT pickup_month, pickup_ts, pickup_zone, dropoff_zone, total_amount
        FROM silver WHERE pickup_month IN {_FILTER_MONTHS}
        """,
    ),
    "filter_valid_timestamps": (
        ["typed"],
        """
        SELECT pickup_ts, dropoff_ts, payment_type, rate_code_id, batch_id
        FROM typed WHERE payment_type IS NOT NULL AND rate_code_id <> 7
        """,
    ),
    "keep_location_keys": (
        ["typed"],
        """
        SELECT pickup_ts, pickup_location_id, dropoff_location_id FROM typed
        WHERE pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
        """,
    ),
    "keep_payment_types": (
        ["typed"],
        "SELECT pickup_ts, payment_type, total_amount FROM typed WHERE payment_type IN (1, 2, 3, 4, 5, 6)",
    ),
    "keep_rate_codes": (
        ["typed"],
        "SELECT pickup_ts, rate_code_id, total_amount FROM typed WHERE rate_code_id IN (1, 2, 3, 4, 5, 6, 99)",
    ),
    "keep_time_order": (
        ["typed"],
        "SELECT pickup_ts, dropoff_ts, total_amount FROM typed WHERE pickup_ts < dropoff_ts",
    ),
    "keep_non_negative": (
        ["typed"],
        "SELECT pickup_ts, fare_amount, trip_distance FROM typed WHERE fare_amount >= 0 AND trip_distance >= 0",
    ),
    "keep_zone_resolved": (
        ["typed", "zones"],
        """
        SELECT pickup_ts, p.zone AS pickup_zone, q.zone AS dropoff_zone, total_amount
        FROM typed JOIN zones p ON pickup_location_id = p.location_id
        JOIN zones q ON dropoff_location_id = q.location_id
        """,
    ),
    "keep_duration_speed": (
        ["measured"],
        """
        SELECT pickup_ts, trip_duration_minutes, trip_speed_mph FROM measured
        WHERE trip_duration_minutes > 0 AND trip_duration_minutes <= 480 AND trip_speed_mph <= 80
        """,
    ),
    "filter_airport_trips": (
        ["fact"],
        """
        SELECT pickup_ts, dropoff_ts, pickup_zone, dropoff_zone, total_amount FROM fact
        WHERE pickup_zone IN ('NATION_3', 'NATION_7', 'NATION_11')
           OR dropoff_zone IN ('NATION_3', 'NATION_7', 'NATION_11')
        """,
    ),
    "enrich_pickup_zone": (
        ["typed", "zones"],
        """
        SELECT pickup_ts, pickup_location_id, total_amount, borough AS pickup_borough, zone AS pickup_zone,
               service_zone AS pickup_service_zone
        FROM typed LEFT JOIN zones ON pickup_location_id = location_id
        """,
    ),
    "enrich_both_zones": (
        ["typed", "zones"],
        """
        SELECT pickup_ts, pickup_location_id, dropoff_location_id, total_amount,
               p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
               q.borough AS dropoff_borough, q.zone AS dropoff_zone, q.service_zone AS dropoff_service_zone
        FROM typed LEFT JOIN zones p ON pickup_location_id = p.location_id
        LEFT JOIN zones q ON dropoff_location_id = q.location_id
        """,
    ),
    "dedup_trips": (
        ["deduped"],
        f"""
        SELECT {_TRIP_ID}, total_amount, payment_type, rate_code_id, vendor_id, passenger_count, batch_id FROM deduped
        """,
    ),
    "dq_trip_checks": (["checks"], _check_rows("checks")),
    "dq_silver_checks": (["silver_checks"], _check_rows("silver_checks")),
    "dq_quarantine_counts": (["enriched"], _quarantine()),
    "silver_trips": (["silver"], "SELECT * FROM silver"),
    "fact_trips": (["fact"], "SELECT * FROM fact"),
    "demand_by_zone_hour_mart": (["demand"], "SELECT * FROM demand"),
    "revenue_by_borough_day_mart": (["revenue"], "SELECT * FROM revenue"),
    "airport_trip_mart": (["airport"], "SELECT * FROM airport"),
    "payment_behavior_mart": (["payment"], "SELECT * FROM payment"),
    "trip_efficiency_mart": (["efficiency"], "SELECT * FROM efficiency"),
    "trip_efficiency_parts": (
        ["fact"],
        """
        SELECT pickup_borough, trip_month, round(sum(trip_distance), 4) AS distance_sum, count(trip_distance) AS distance_n,
               round(sum(trip_duration_minutes), 4) AS duration_sum, count(trip_duration_minutes) AS duration_n,
               round(sum(mile_fare), 4) AS mile_fare_sum, count(mile_fare) AS mile_fare_n,
               round(sum(minute_fare), 4) AS minute_fare_sum, count(minute_fare) AS minute_fare_n
        FROM (SELECT *, fare_amount / CASE WHEN trip_distance > 0 THEN trip_distance END AS mile_fare,
                     fare_amount / CASE WHEN trip_duration_minutes > 0 THEN trip_duration_minutes END AS minute_fare FROM fact)
        GROUP BY pickup_borough, trip_month
        """,
    ),
    "report_hourly_demand": (
        ["demand"],
        "SELECT trip_date, trip_hour, pickup_borough, pickup_zone, pickup_trip_count FROM demand",
    ),
    "report_daily_revenue": (["revenue"], "SELECT trip_date, pickup_borough, daily_revenue FROM revenue"),
    "report_monthly_revenue": (
        ["revenue"],
        """
        SELECT CAST(date_trunc('month', trip_date) AS TIMESTAMP) AS revenue_month, pickup_borough,
               CAST(sum(CAST(daily_revenue AS DECIMAL(18,2))) AS DOUBLE) AS monthly_revenue
        FROM revenue GROUP BY 1, 2
        """,
    ),
    "report_peak_zone_hour": (
        ["demand"],
        """
        SELECT pickup_zone, trip_hour, CAST(sum(pickup_trip_count) AS BIGINT) AS hourly_demand
        FROM demand GROUP BY 1, 2 ORDER BY hourly_demand DESC, pickup_zone, trip_hour LIMIT 20
        """,
    ),
    "report_distance_duration": (
        ["efficiency"],
        "SELECT pickup_borough, avg_trip_distance, avg_trip_duration_minutes FROM efficiency",
    ),
    "report_airport_routes": (["airport"], "SELECT pickup_zone, dropoff_zone, trip_count, revenue FROM airport"),
    "report_payment_trends": (
        ["payment"],
        "SELECT trip_date, pickup_borough, payment_type, trip_count, total_revenue FROM payment",
    ),
    "report_zone_ranking": (
        ["demand"],
        """
        SELECT pickup_zone, CAST(sum(pickup_trip_count) AS BIGINT) AS total_pickups,
               CAST(dense_rank() OVER (ORDER BY sum(pickup_trip_count) DESC) AS INTEGER) AS demand_rank
        FROM demand GROUP BY pickup_zone ORDER BY demand_rank, pickup_zone LIMIT 25
        """,
    ),
    "zone_daily_demand": (["zone_daily"], "SELECT * FROM zone_daily"),
    "zone_demand_stats": (
        ["zone_stats"],
        """
        SELECT pickup_zone, round(avg_pickups, 4) AS avg_pickups, round(std_pickups, 4) AS std_pickups FROM zone_stats
        """,
    ),
    "report_demand_spikes": (
        ["zone_daily", "zone_stats"],
        """
        SELECT trip_date, d.pickup_zone, pickups,
               round((pickups - avg_pickups) / nullif(std_pickups, 0), 4) AS z_score
        FROM zone_daily d JOIN zone_stats s ON d.pickup_zone = s.pickup_zone
        WHERE (pickups - avg_pickups) / nullif(std_pickups, 0) > 2.5
        """,
    ),
    "dash_kpi_snapshot": (
        ["fact"],
        """
        SELECT count(*) AS total_trips, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
               round(avg(fare_amount), 2) AS avg_fare, round(avg(trip_distance), 2) AS avg_trip_distance
        FROM fact
        """,
    ),
    "dash_monthly_trips": (
        ["fact"],
        """
        SELECT CAST(date_trunc('month', trip_date) AS TIMESTAMP) AS month, count(*) AS trip_count FROM fact GROUP BY 1
        """,
    ),
    "dash_hourly_heatmap": (
        ["demand"],
        """
        SELECT trip_date, trip_hour, pickup_borough, CAST(sum(pickup_trip_count) AS BIGINT) AS trips
        FROM demand GROUP BY 1, 2, 3
        """,
    ),
    "dash_top_zones": (
        ["demand"],
        """
        SELECT pickup_zone, CAST(sum(pickup_trip_count) AS BIGINT) AS total_pickups
        FROM demand GROUP BY pickup_zone ORDER BY total_pickups DESC, pickup_zone LIMIT 25
        """,
    ),
    "dash_trip_efficiency": (["efficiency"], "SELECT * FROM efficiency"),
    "dash_airport_revenue_rank": (
        ["airport"],
        """
        SELECT *, CAST(dense_rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS revenue_rank
        FROM (SELECT pickup_zone, dropoff_zone, CAST(sum(trip_count) AS BIGINT) AS trip_count,
                     CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
              FROM airport GROUP BY ALL)
        """,
    ),
    "nb_summary_metrics": (
        ["demand", "revenue"],
        """
        SELECT 'Total Trips Processed' AS metric, CAST(sum(pickup_trip_count) AS DOUBLE) AS value FROM demand
        UNION ALL SELECT 'Average Trips per Zone-Hour', round(avg(pickup_trip_count), 2) FROM demand
        UNION ALL SELECT 'Total Revenue (USD)', round(sum(daily_revenue), 2) FROM revenue
        UNION ALL SELECT 'Average Borough-Day Revenue (USD)', round(avg(daily_revenue), 2) FROM revenue
        """,
    ),
    "nb_top_zone_hours": (
        ["demand"],
        """
        SELECT * FROM demand ORDER BY pickup_trip_count DESC, trip_date, trip_hour, pickup_location_id LIMIT 10
        """,
    ),
    "nb_hourly_volume": (
        ["demand"],
        "SELECT trip_hour, CAST(sum(pickup_trip_count) AS BIGINT) AS trip_count FROM demand GROUP BY trip_hour",
    ),
    "nb_revenue_by_borough": (
        ["revenue"],
        """
        SELECT pickup_borough, CAST(sum(CAST(daily_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM revenue GROUP BY pickup_borough
        """,
    ),
}

# The incremental job delivers each trip once, in the file of its dropoff month. A
# trip is kept when the run that loads its own (pickup) month comes no earlier
# than the run that loads its file: months up to July 1999 in the first run.
_DELIVERED_ONCE = {"bronze": (["raw"], "SELECT *, 'trips' AS source_name, 'run' AS batch_id FROM raw")}
_PIPELINE = """
SELECT CAST(pickup_ts AS DATE) AS trip_date, CAST(hour(pickup_ts) AS INTEGER) AS trip_hour,
       pickup_month AS trip_month, pickup_location_id, pickup_borough, pickup_zone,
       count(*) AS pickup_trip_count, CAST(sum(passenger_count) AS BIGINT) AS passenger_total
FROM silver
WHERE pickup_month BETWEEN (SELECT min(file_month) FROM raw) AND (SELECT max(file_month) FROM raw)
  AND NOT (pickup_month <= '1999-07' AND strftime(dropoff_ts, '%Y-%m') > '1999-07')
GROUP BY ALL
"""


def all_sql() -> dict[str, str]:
    sql = {name: _with(relations, body) for name, (relations, body) in _QUERIES.items()}
    sql["pipeline_incremental"] = _with(["silver"], _PIPELINE, _DELIVERED_ONCE)
    return sql
