"""DuckDB SQL of the queries in analysis, over the supplied tables alone."""

from workload.oracle import _with

_ZONE_NAMES = """
    SELECT location_id, zone || '/' || v AS zone_then,
           make_timestamp(1000000 * (707356800 + (location_id * 53 + v * 500) * 86400 + location_id * 3600 + v * 17))
               AS valid_from
    FROM (SELECT location_id, zone, unnest(range(4)) AS v FROM zones)
"""
_NAMED = f"""
    SELECT f.pickup_ts, f.dropoff_ts, f.pickup_location_id, f.fare_amount, f.trip_distance, n.zone_then, n.valid_from
    FROM fact f LEFT JOIN (
        SELECT *, lead(valid_from) OVER (PARTITION BY location_id ORDER BY valid_from) AS valid_to FROM ({_ZONE_NAMES})) n
    ON f.pickup_location_id = n.location_id AND f.pickup_ts >= n.valid_from
       AND (n.valid_to IS NULL OR f.pickup_ts < n.valid_to)
"""
_PAIRS = """
    SELECT a.pickup_location_id, CAST(greatest(a.pickup_ts, b.pickup_ts) AS DATE) AS trip_date, count(*) AS pairs,
           CAST(sum(date_diff('second', greatest(a.pickup_ts, b.pickup_ts), least(a.dropoff_ts, b.dropoff_ts))) AS BIGINT)
               AS overlap_seconds
    FROM fact a JOIN fact b
      ON a.pickup_location_id = b.pickup_location_id AND a.pickup_ts < b.dropoff_ts AND b.pickup_ts < a.dropoff_ts
     AND (a.pickup_ts, a.dropoff_ts, a.dropoff_location_id, a.fare_amount, a.trip_distance)
       < (b.pickup_ts, b.dropoff_ts, b.dropoff_location_id, b.fare_amount, b.trip_distance)
    GROUP BY 1, 2
"""
_REVENUE = "CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, CAST(sum(trip_count) AS BIGINT) AS trips"

# query -> (relations, SQL body)
_QUERIES: dict[str, tuple[list[str], str]] = {
    "moving_zone_demand": (
        ["zone_daily"],
        """
        SELECT pickup_zone, trip_date, pickups, least(known, 7) AS days_known, CAST(moving_sum AS BIGINT) AS moving_sum,
               CASE WHEN known > 1 THEN pickups - day_before END AS change_to_day,
               CASE WHEN known > 7 THEN pickups - week_before END AS change_to_span,
               round(moving_sum / least(known, 7), 4) AS moving_avg
        FROM (
            SELECT *, CAST(row_number() OVER days AS INTEGER) AS known, lag(pickups) OVER days AS day_before,
                   lag(pickups, 7) OVER days AS week_before,
                   sum(pickups) OVER (days ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_sum
            FROM (
                SELECT s.pickup_zone, s.trip_date, coalesce(d.pickups, 0) AS pickups FROM (
                    SELECT pickup_zone, CAST(unnest(generate_series(min(trip_date), max(trip_date), INTERVAL 1 DAY)) AS DATE)
                        AS trip_date
                    FROM zone_daily GROUP BY pickup_zone) s
                LEFT JOIN zone_daily d ON s.pickup_zone = d.pickup_zone AND s.trip_date = d.trip_date)
            WINDOW days AS (PARTITION BY pickup_zone ORDER BY trip_date))
        """,
    ),
    "moving_demand_of_days_with_pickups": (
        ["zone_daily"],
        """
        SELECT d.pickup_zone, d.trip_date, d.pickups, d.days_known, CAST(sum(e.pickups) AS BIGINT) AS moving_sum,
               CASE WHEN known > 1 THEN d.pickups - CAST(coalesce(sum(e.pickups) FILTER (e.trip_date = d.trip_date - 1), 0) AS BIGINT)
               END AS change_to_day,
               CASE WHEN known > 28 THEN d.pickups - coalesce(any_value(b.pickups), 0) END AS change_to_span,
               round(sum(e.pickups) / d.days_known, 4) AS moving_avg
        FROM (SELECT *, CAST(least(trip_date - first_day + 1, 28) AS INTEGER) AS days_known, trip_date - first_day + 1 AS known
              FROM (SELECT *, min(trip_date) OVER (PARTITION BY pickup_zone) AS first_day FROM zone_daily)) d
        JOIN zone_daily e ON d.pickup_zone = e.pickup_zone AND e.trip_date BETWEEN d.trip_date - 27 AND d.trip_date
        LEFT JOIN zone_daily b ON d.pickup_zone = b.pickup_zone AND b.trip_date = d.trip_date - 28
        GROUP BY d.pickup_zone, d.trip_date, d.pickups, d.days_known, d.known
        """,
    ),
    "borough_month_to_date": (
        ["revenue"],
        """
        SELECT trip_date, trip_month, pickup_borough, daily_revenue, CAST(so_far AS DOUBLE) AS running_amount,
               round(CAST(so_far AS DOUBLE) / nullif(CAST(whole AS DOUBLE), 0), 4) AS share_of_whole
        FROM (
            SELECT *, sum(CAST(daily_revenue AS DECIMAL(18,2))) OVER (PARTITION BY pickup_borough, trip_month ORDER BY trip_date)
                       AS so_far,
                   sum(CAST(daily_revenue AS DECIMAL(18,2))) OVER (PARTITION BY pickup_borough, trip_month) AS whole
            FROM revenue)
        """,
    ),
    "asof_zone_names": (["fact", "zones"], _NAMED),
    "asof_recent_zone_names": (
        ["fact", "zones"],
        f"""
        SELECT CASE WHEN pickup_ts - valid_from <= INTERVAL 200 DAY THEN zone_then END AS zone_then, count(*) AS trips,
               CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fares
        FROM ({_NAMED}) GROUP BY 1
        """,
    ),
    "overlapping_trips": (["fact"], _PAIRS),
    "zone_concurrency": (
        ["fact"],
        f"""
        SELECT e.pickup_location_id, e.trip_date, CAST(peak AS BIGINT) AS peak, coalesce(pairs, 0) AS pairs, begun
        FROM (
            SELECT pickup_location_id, CAST(t AS DATE) AS trip_date, max(under_way) AS peak, CAST(sum(begun) AS BIGINT) AS begun
            FROM (
                SELECT pickup_location_id, t, begun, sum(net) OVER (PARTITION BY pickup_location_id ORDER BY t) AS under_way
                FROM (
                    SELECT pickup_location_id, t, sum(d) AS net, count(*) FILTER (d > 0) AS begun
                    FROM (SELECT pickup_location_id, pickup_ts AS t, 1 AS d FROM fact
                          UNION ALL SELECT pickup_location_id, dropoff_ts, -1 FROM fact)
                    GROUP BY 1, 2))
            GROUP BY 1, 2) e
        LEFT JOIN ({_PAIRS}) p ON e.pickup_location_id = p.pickup_location_id AND e.trip_date = p.trip_date
        """,
    ),
    "revenue_rollup": (
        ["payment"],
        f"""
        SELECT trip_month, pickup_borough, payment_type, {_REVENUE},
               CAST(grouping(trip_month, pickup_borough, payment_type) AS INTEGER) AS level
        FROM payment GROUP BY ROLLUP (trip_month, pickup_borough, payment_type)
        """,
    ),
    "revenue_grouping_sets": (
        ["payment"],
        f"""
        SELECT pickup_borough, payment_type, trip_month, {_REVENUE},
               CAST(grouping(pickup_borough, payment_type, trip_month) AS INTEGER) AS level
        FROM payment
        GROUP BY GROUPING SETS ((pickup_borough, payment_type), (trip_month, payment_type), (pickup_borough), ())
        """,
    ),
    "payments_side_by_side": (
        ["payment"],
        "SELECT trip_month, pickup_borough, "
        + ", ".join(f"CAST(sum(trip_count) FILTER (payment_type = {n}) AS BIGINT) AS trips_of_{n}" for n in range(1, 7))
        + " FROM payment GROUP BY 1, 2",
    ),
    "sketched_months": (
        ["fact"],
        """
        SELECT substr(trip_month, 1, 4) AS year, count(*) AS row_count,
               count(DISTINCT (pickup_location_id, dropoff_location_id, trip_date)) AS route_days,
               TRUE AS distinct_near, TRUE AS quartiles_near
        FROM fact GROUP BY 1
        """,
    ),
    "stream_hourly_demand": (
        ["raw"],
        """
        SELECT CAST("PULocationID" AS INTEGER) AS pickup_location_id, date_trunc('hour', tpep_pickup_datetime) AS hour_start,
               count(*) AS trips, CAST(sum(CAST(passenger_count AS INTEGER)) AS BIGINT) AS passengers,
               strftime(date_trunc('hour', tpep_pickup_datetime), '%Y-%m') AS hour_month
        FROM raw GROUP BY ALL
        """,
    ),
    "zone_busy_spells": (
        ["fact"],
        """
        SELECT pickup_zone, min(pickup_ts) AS begins, max(pickup_ts) + INTERVAL 1800 SECOND AS ends, count(*) AS row_count,
               CAST(sum(passenger_count) AS BIGINT) AS passenger_count, count(DISTINCT pickup_ts) AS instants
        FROM (
            SELECT *, sum(starts) OVER (PARTITION BY pickup_zone ORDER BY pickup_ts) AS spell FROM (
                SELECT pickup_zone, pickup_ts, passenger_count,
                       CASE WHEN pickup_ts - lag(pickup_ts) OVER (PARTITION BY pickup_zone ORDER BY pickup_ts)
                                 <= INTERVAL 1800 SECOND THEN 0 ELSE 1 END AS starts
                FROM fact))
        GROUP BY pickup_zone, spell
        """,
    ),
    "zones_above_borough_mean": (
        ["demand"],
        """
        SELECT pickup_borough, pickup_zone, pickups FROM (
            SELECT *, avg(pickups) OVER (PARTITION BY pickup_borough) AS mean FROM (
                SELECT pickup_borough, pickup_zone, CAST(sum(pickup_trip_count) AS BIGINT) AS pickups FROM demand GROUP BY 1, 2))
        WHERE pickups > mean
        """,
    ),
    "zones_with_airport_route": (
        ["zones", "airport"],
        "SELECT location_id, zone FROM zones WHERE zone IN (SELECT pickup_zone FROM airport WHERE trip_count >= 2)",
    ),
    "days_without_card_payment": (
        ["payment"],
        """
        SELECT trip_date, pickup_borough FROM payment GROUP BY 1, 2
        HAVING count(*) FILTER (payment_type = 1) = 0
        """,
    ),
    "days_above_week_before": (
        ["zone_daily"],
        """
        SELECT d.pickup_zone, d.trip_date, d.pickups
        FROM zone_daily d JOIN zone_daily e
          ON d.pickup_zone = e.pickup_zone AND e.trip_date BETWEEN d.trip_date - 7 AND d.trip_date - 1
        GROUP BY d.pickup_zone, d.trip_date, d.pickups HAVING d.pickups > max(e.pickups)
        """,
    ),
    "bucketed_zone_shares": (
        ["fact", "demand"],
        """
        SELECT f.pickup_location_id, trips, fares, busiest_hour FROM (
            SELECT pickup_location_id, count(*) AS trips, CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fares
            FROM fact GROUP BY 1) f
        JOIN (SELECT pickup_location_id, max(pickup_trip_count) AS busiest_hour FROM demand GROUP BY 1) d
          ON f.pickup_location_id = d.pickup_location_id
        """,
    ),
    "upsert_corrections": (
        ["demand"],
        """
        SELECT * EXCLUDE (touched) REPLACE (
                   CASE WHEN NOT touched THEN pickup_trip_count WHEN trip_hour = 7 THEN pickup_trip_count + 2000
                        ELSE pickup_trip_count + 1000 END AS pickup_trip_count)
        FROM (SELECT *, trip_month IN ('1995-03', '1997-11') AND pickup_location_id % 3 = 0 AS touched FROM demand)
        WHERE NOT (touched AND trip_hour = 5)
        UNION ALL
        SELECT * REPLACE (33 AS trip_hour) FROM demand
        WHERE trip_month IN ('1995-03', '1997-11') AND pickup_location_id % 3 = 0 AND trip_hour = 9
        """,
    ),
}


def all_sql() -> dict[str, str]:
    return {name: _with(relations, body) for name, (relations, body) in _QUERIES.items()}
