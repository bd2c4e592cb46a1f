"""Zone days whose demand stands out from the zone's own history."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zone_days(demand: DataFrame) -> DataFrame:
    """Pickups per zone name and day; days without a pickup have no row."""
    return demand.groupBy("trip_date", "pickup_zone").agg(F.sum("pickup_trip_count").alias("pickups"))


def zone_statistics(days: DataFrame) -> DataFrame:
    """Mean and population deviation of a zone's daily pickups."""
    return days.groupBy("pickup_zone").agg(
        F.avg("pickups").alias("avg_pickups"), F.stddev_pop("pickups").alias("std_pickups")
    )


def demand_spikes(demand: DataFrame, threshold: float = 2.5) -> DataFrame:
    """Zone days with a z-score above the threshold.

    A zone that never varies has no z-score and no spikes. Both sides come from
    one aggregation of the mart, whose exchange is reused.
    """
    days = zone_days(demand)
    scored = days.join(zone_statistics(days), "pickup_zone").select(
        "trip_date",
        "pickup_zone",
        "pickups",
        ((F.col("pickups") - F.col("avg_pickups")) / F.nullif("std_pickups", F.lit(0.0))).alias("z_score"),
    )
    return scored.where(F.col("z_score") > threshold)
