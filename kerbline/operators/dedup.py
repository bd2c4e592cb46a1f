"""Duplicate removal with a named survivor."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRIP_KEY = [
    "pickup_ts",
    "dropoff_ts",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
    "trip_distance",
]


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under `order`; NULL key values group together.

    The rank filter becomes a group limit that also runs before the shuffle, so a
    key with a huge number of copies sends at most one row per input task to the
    task that owns it.
    """
    ranked = df.withColumn("_copy", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_copy") == 1).drop("_copy")


def dedup_trips(trips: DataFrame) -> DataFrame:
    """One row per trip key: latest load, then a fixed order.

    Batch ids are names and say nothing about time, so the load time decides; the
    ids follow only for rows without one. Every remaining column closes the order, so rows that still tie are equal and
    the result is the same on every run.
    """
    loaded = [F.desc_nulls_last("ingestion_timestamp")] if "ingestion_timestamp" in trips.columns else []
    leading = [
        *loaded,
        F.desc_nulls_last("batch_id"),
        F.desc_nulls_last("total_amount"),
        F.asc_nulls_last("payment_type"),
        F.asc_nulls_last("rate_code_id"),
        F.asc_nulls_last("vendor_id"),
        F.asc_nulls_last("passenger_count"),
    ]
    used = {*TRIP_KEY, "ingestion_timestamp", "batch_id", "total_amount", "payment_type", "rate_code_id", "vendor_id", "passenger_count"}
    rest = [F.asc_nulls_last(name) for name in trips.columns if name not in used]
    return first_per_key(trips, TRIP_KEY, leading + rest)


def dedup_zones(zones: DataFrame) -> DataFrame:
    """One row per location: the smallest (borough, zone, service zone)."""
    order = [F.asc_nulls_last(name) for name in ("borough", "zone", "service_zone")]
    return first_per_key(zones, ["location_id"], order)
