"""The zone dimension in its pickup and dropoff roles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zone_role(zones: DataFrame, role: str) -> DataFrame:
    """The dimension renamed for one role ('pickup' or 'dropoff')."""
    return zones.select(
        F.col("location_id").alias(f"{role}_location_id"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def add_zone(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Left join the role's zone columns on; unresolved locations stay as NULLs.

    No broadcast hint: Spark ships the lookup to the tasks only while its size
    estimate is under spark.sql.autoBroadcastJoinThreshold. A larger lookup turns
    into a shuffle join, where adaptive skew handling splits the trips of a
    dominant zone.
    """
    return trips.join(zone_role(zones, role), f"{role}_location_id", "left")


def add_both_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return add_zone(add_zone(trips, zones, "pickup"), zones, "dropoff")
