"""Reports over the marts.

Each takes marts and returns a DataFrame, sorted the way it is read, with a
complete tie-break so that equal rows cannot change places or fall off a limit.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.money import money_avg, money_sum
from kerbline.operators.ranking import top_dense_rank
from kerbline.operators.spikes import demand_spikes


def _up(*names: str) -> list[Column]:
    return [F.asc_nulls_last(name) for name in names]


def _down(*names: str) -> list[Column]:
    return [F.desc_nulls_last(name) for name in names]


# -- demand ---------------------------------------------------------------


def hourly_demand(demand: DataFrame) -> DataFrame:
    columns = ["trip_date", "trip_hour", "pickup_borough", "pickup_zone", "pickup_trip_count"]
    order = [*_up("trip_date", "trip_hour"), *_down("pickup_trip_count"), *_up("pickup_borough", "pickup_zone")]
    return demand.select(*columns).orderBy(*order)


def peak_zone_hours(demand: DataFrame, k: int = 20) -> DataFrame:
    hours = demand.groupBy("pickup_zone", "trip_hour").agg(F.sum("pickup_trip_count").alias("hourly_demand"))
    return hours.orderBy(*_down("hourly_demand"), *_up("pickup_zone", "trip_hour")).limit(k)


def _zone_totals(demand: DataFrame) -> DataFrame:
    return demand.groupBy("pickup_zone").agg(F.sum("pickup_trip_count").alias("total_pickups"))


def zone_ranking(demand: DataFrame, k: int = 25) -> DataFrame:
    """The k busiest zones with their dense rank; the limit counts rows, not ranks."""
    ranked = top_dense_rank(_zone_totals(demand), "total_pickups", ["pickup_zone"], k, "demand_rank")
    return ranked.orderBy(*_up("demand_rank", "pickup_zone"))


def top_zones(demand: DataFrame, k: int = 25) -> DataFrame:
    return _zone_totals(demand).orderBy(*_down("total_pickups"), *_up("pickup_zone")).limit(k)


def spikes(demand: DataFrame, threshold: float = 2.5) -> DataFrame:
    return demand_spikes(demand, threshold).orderBy(*_down("z_score"), *_up("trip_date", "pickup_zone"))


def hourly_heatmap(demand: DataFrame) -> DataFrame:
    cells = demand.groupBy("trip_date", "trip_hour", "pickup_borough").agg(F.sum("pickup_trip_count").alias("trips"))
    return cells.orderBy(*_up("trip_date", "trip_hour", "pickup_borough"))


def top_zone_hours(demand: DataFrame, k: int = 10) -> DataFrame:
    """The k mart rows with the most pickups, all their columns."""
    return demand.orderBy(*_down("pickup_trip_count"), *_up("trip_date", "trip_hour", "pickup_location_id")).limit(k)


def hourly_volume(demand: DataFrame) -> DataFrame:
    """Trips per hour of day."""
    return demand.groupBy("trip_hour").agg(F.sum("pickup_trip_count").alias("trip_count")).orderBy(*_up("trip_hour"))


# -- revenue and payments -------------------------------------------------


def daily_revenue(revenue: DataFrame) -> DataFrame:
    order = [*_up("trip_date"), *_down("daily_revenue"), *_up("pickup_borough")]
    return revenue.select("trip_date", "pickup_borough", "daily_revenue").orderBy(*order)


def monthly_revenue(revenue: DataFrame) -> DataFrame:
    months = revenue.groupBy(F.date_trunc("month", "trip_date").alias("revenue_month"), "pickup_borough").agg(
        money_sum("daily_revenue").alias("monthly_revenue")
    )
    return months.orderBy(*_up("revenue_month"), *_down("monthly_revenue"), *_up("pickup_borough"))


def revenue_by_borough(revenue: DataFrame) -> DataFrame:
    totals = revenue.groupBy("pickup_borough").agg(money_sum("daily_revenue").alias("revenue"))
    return totals.orderBy(*_down("revenue"), *_up("pickup_borough"))


def payment_trends(payment: DataFrame) -> DataFrame:
    columns = ["trip_date", "pickup_borough", "payment_type", "trip_count", "total_revenue"]
    order = [*_up("trip_date"), *_down("trip_count"), *_up("pickup_borough", "payment_type")]
    return payment.select(*columns).orderBy(*order)


# -- airports -------------------------------------------------------------


def airport_routes(airport: DataFrame) -> DataFrame:
    """Routes by volume; the mart is monthly, so a route appears once per month."""
    order = [*_down("trip_count", "revenue"), *_up("pickup_zone", "dropoff_zone", "trip_month")]
    return airport.orderBy(*order).select("pickup_zone", "dropoff_zone", "trip_count", "revenue")


def airport_revenue_rank(airport: DataFrame) -> DataFrame:
    """Routes summed over all months, ranked by revenue. One row per pair of zones meets in the window; where a relation
    has far more rows than that, `dense_rank_desc` ranks it in ranges."""
    routes = airport.groupBy("pickup_zone", "dropoff_zone").agg(
        F.sum("trip_count").alias("trip_count"), money_sum("revenue").alias("revenue")
    )
    ranked = routes.withColumn("revenue_rank", F.dense_rank().over(Window.orderBy(*_down("revenue"))))
    return ranked.orderBy(*_up("revenue_rank", "pickup_zone", "dropoff_zone"))


# -- efficiency -----------------------------------------------------------


def distance_duration(efficiency: DataFrame) -> DataFrame:
    columns = ["pickup_borough", "avg_trip_distance", "avg_trip_duration_minutes"]
    return efficiency.select(*columns).orderBy(*_down("avg_trip_distance"), *_up("pickup_borough"))


def trip_efficiency(efficiency: DataFrame) -> DataFrame:
    columns = [
        "pickup_borough",
        "avg_trip_distance",
        "avg_trip_duration_minutes",
        "avg_fare_per_mile",
        "avg_fare_per_minute",
    ]
    return efficiency.select(*columns).orderBy(*_down("avg_fare_per_mile"), *_up("pickup_borough"))


# -- headline numbers -----------------------------------------------------


def kpi_snapshot(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_trips"),
        F.round(money_sum("total_amount"), 2).alias("total_revenue"),
        F.round(money_avg("fare_amount"), 2).alias("avg_fare"),
        F.round(F.avg("trip_distance"), 2).alias("avg_trip_distance"),
    )


def monthly_trips(fact: DataFrame) -> DataFrame:
    months = fact.groupBy(F.date_trunc("month", "trip_date").alias("month")).agg(F.count("*").alias("trip_count"))
    return months.orderBy(*_up("month"))


def summary_metrics(demand: DataFrame, revenue: DataFrame) -> DataFrame:
    """Four (metric, value) rows from one pass over each mart."""
    metrics = [
        demand.agg(
            F.sum("pickup_trip_count").cast("double").alias("Total Trips Processed"),
            F.round(F.avg("pickup_trip_count"), 2).alias("Average Trips per Zone-Hour"),
        ),
        revenue.agg(
            F.round(money_sum("daily_revenue"), 2).alias("Total Revenue (USD)"),
            F.round(money_avg("daily_revenue"), 2).alias("Average Borough-Day Revenue (USD)"),
        ),
    ]
    return reduce(DataFrame.union, [one.unpivot([], one.columns, "metric", "value") for one in metrics])
