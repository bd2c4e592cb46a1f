"""Gold: the trip fact and the marts built on it.

Every mart groups by columns with few distinct values, so each task combines its
rows before the shuffle and a dominant zone or day costs one row per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.functions import trips as tf
from kerbline.functions.money import exact_sum, money_sum, other_sum, total

# Zone names that count as airports.
AIRPORTS = ("JFK Airport", "LaGuardia Airport", "Newark Airport")


def _published(mart: DataFrame, contract: str) -> DataFrame:
    return mart.select(*schemas.names(contract))


def fact_trips(silver: DataFrame) -> DataFrame:
    parts = {
        "trip_date": F.to_date("pickup_ts"),
        "trip_hour": F.hour("pickup_ts"),
        "trip_month": tf.month_key("pickup_ts"),
    }
    return _published(silver.withColumns(parts), schemas.FACT_TRIP)


def demand_mart(fact: DataFrame) -> DataFrame:
    """Trips and passengers per zone and hour."""
    keys = ["trip_date", "trip_hour", "trip_month", "pickup_location_id", "pickup_borough", "pickup_zone"]
    mart = fact.groupBy(*keys).agg(
        F.count("*").alias("pickup_trip_count"), F.sum("passenger_count").alias("passenger_total")
    )
    return _published(mart, schemas.DEMAND_MART)


def payment_days(fact: DataFrame) -> DataFrame:
    """Sums, in their two parts, and counts per borough, day and payment type: one pass for two marts."""
    return fact.groupBy("trip_date", "trip_month", "pickup_borough", "payment_type").agg(
        F.count("*").alias("trip_count"),
        exact_sum("total_amount").alias("total_exact"),
        other_sum("total_amount").alias("total_other"),
        exact_sum("fare_amount").alias("fare_exact"),
        other_sum("fare_amount").alias("fare_other"),
    )


def payment_mart(days: DataFrame) -> DataFrame:
    """Trips and revenue per borough, day and payment type, from `payment_days`."""
    revenue = total(F.col("total_exact"), F.col("total_other"))
    return _published(days.withColumn("total_revenue", revenue), schemas.PAYMENT_MART)


def revenue_mart(days: DataFrame) -> DataFrame:
    """Revenue, fares and trips per borough and day, from `payment_days`."""
    mart = days.groupBy("trip_date", "trip_month", "pickup_borough").agg(
        total(F.sum("total_exact"), F.sum("total_other")).alias("daily_revenue"),
        total(F.sum("fare_exact"), F.sum("fare_other")).alias("daily_fare"),
        F.sum("trip_count").alias("trip_count"),
    )
    return _published(mart, schemas.REVENUE_MART)


def airport_trips(fact: DataFrame, airports: tuple[str, ...] = AIRPORTS) -> DataFrame:
    """Trips that start or end at an airport."""
    return fact.where(F.col("pickup_zone").isin(*airports) | F.col("dropoff_zone").isin(*airports))


def airport_mart(fact: DataFrame, airports: tuple[str, ...] = AIRPORTS) -> DataFrame:
    """Trips and revenue per airport route and month."""
    routes = airport_trips(fact, airports).groupBy("trip_month", "pickup_zone", "dropoff_zone")
    mart = routes.agg(F.count("*").alias("trip_count"), money_sum("total_amount").alias("revenue"))
    return _published(mart, schemas.AIRPORT_MART)


# Measure prefix of the efficiency parts -> the per-trip value that is averaged.
def _efficiency_values() -> dict[str, Column]:
    return {
        "distance": F.col("trip_distance"),
        "duration": F.col("trip_duration_minutes"),
        "mile_fare": tf.per_unit("fare_amount", "trip_distance"),
        "minute_fare": tf.per_unit("fare_amount", "trip_duration_minutes"),
    }


_EFFICIENCY_NAMES = {
    "distance": "avg_trip_distance",
    "duration": "avg_trip_duration_minutes",
    "mile_fare": "avg_fare_per_mile",
    "minute_fare": "avg_fare_per_minute",
}


def efficiency_parts(fact: DataFrame) -> DataFrame:
    """Sums and counts per borough and month behind the averages.

    The mart covers every month ever loaded. Kept per month, a run only has to
    read the months it loaded instead of the whole history.
    """
    measures = []
    for name, value in _efficiency_values().items():
        measures += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    return _published(fact.groupBy("trip_month", "pickup_borough").agg(*measures), schemas.EFFICIENCY_PARTS)


def efficiency_mart(parts: DataFrame) -> DataFrame:
    """Averages per borough over all trips, from `efficiency_parts`: means of per-trip ratios, not ratios of sums."""
    averages = [
        F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(published)
        for name, published in _EFFICIENCY_NAMES.items()
    ]
    return parts.groupBy("pickup_borough").agg(*averages)
