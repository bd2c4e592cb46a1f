"""Rows chosen by comparing them with other rows: correlated and EXISTS subqueries.

Written as SQL over the given frames; Spark turns each into a join on the
correlated column, so none runs once per row.
"""

from pyspark.sql import DataFrame


def zones_above_borough_mean(demand: DataFrame) -> DataFrame:
    """Zones with more pickups than the mean zone of their borough."""
    return demand.sparkSession.sql(
        """
        WITH zone_totals AS (
            SELECT pickup_borough, pickup_zone, SUM(pickup_trip_count) AS pickups FROM {demand} GROUP BY 1, 2)
        SELECT z.pickup_borough, z.pickup_zone, z.pickups FROM zone_totals z
        WHERE z.pickups > (SELECT AVG(o.pickups) FROM zone_totals o WHERE o.pickup_borough = z.pickup_borough)
        """,
        demand=demand,
    )


def zones_with_airport_route(zones: DataFrame, airport: DataFrame, trips_at_least: int = 1) -> DataFrame:
    """Zones from which an airport route of some month had as many trips as asked for."""
    return zones.sparkSession.sql(
        """
        SELECT z.location_id, z.zone FROM {zones} z
        WHERE EXISTS (SELECT 1 FROM {airport} a WHERE a.pickup_zone = z.zone AND a.trip_count >= :least)
        """,
        {"least": trips_at_least},
        zones=zones,
        airport=airport,
    )


def days_without_payment(payment: DataFrame, payment_type: int) -> DataFrame:
    """Borough days on which no trip was paid in the given way."""
    return payment.sparkSession.sql(
        """
        SELECT DISTINCT p.trip_date, p.pickup_borough FROM {payment} p
        WHERE NOT EXISTS (
            SELECT 1 FROM {payment} q
            WHERE q.trip_date = p.trip_date AND q.pickup_borough = p.pickup_borough AND q.payment_type = :kind)
        """,
        {"kind": payment_type},
        payment=payment,
    )


def days_above_all_of_week_before(days: DataFrame) -> DataFrame:
    """Zone days with more pickups than each of the seven days before that has any; at least one has to have some."""
    return days.sparkSession.sql(
        """
        SELECT d.pickup_zone, d.trip_date, d.pickups FROM {days} d
        WHERE d.pickups > (
            SELECT MAX(e.pickups) FROM (
                SELECT pickup_zone, pickups, EXPLODE(SEQUENCE(DATE_ADD(trip_date, 1), DATE_ADD(trip_date, 7))) AS later FROM {days}) e
            WHERE e.pickup_zone = d.pickup_zone AND e.later = d.trip_date)
        """,
        days=days,
    )
