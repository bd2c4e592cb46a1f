"""Silver: typed, deduplicated, zone-enriched and filtered trips; clean zones."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kerbline import schemas
from kerbline.functions import trips as tf
from kerbline.functions.months import in_months
from kerbline.operators.dedup import dedup_trips, dedup_zones
from kerbline.operators.quality import TripLimits, keep_valid, trip_rules
from kerbline.operators.zones import add_both_zones
from kerbline.sinks import gather_months

# Columns silver publishes as they are; no rule or key reads them.
PASSED_THROUGH = [
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "source_name",
    "source_file",
]


def select_contract(bronze: DataFrame) -> DataFrame:
    """The business and load columns silver starts from, and no others."""
    return bronze.select(*schemas.names(schemas.BRONZE_TRIP))


def typed_trips(
    bronze: DataFrame, lenient: bool = False, carried: list[str] | tuple[str, ...] = tuple(PASSED_THROUGH)
) -> DataFrame:
    """Rename and cast the raw columns; `carried` columns come along unchanged.

    A value that does not fit its type raises; with `lenient` it becomes NULL and
    the quality rules decide about the row.
    """

    def to(name: str, kind: str) -> Column:
        return F.col(name).try_cast(kind) if lenient else F.col(name).cast(kind)

    def ts(name: str) -> Column:
        is_text = isinstance(bronze.schema[name].dataType, StringType)
        return F.try_to_timestamp(name) if lenient and is_text else F.to_timestamp(name)

    return bronze.select(
        ts("tpep_pickup_datetime").alias("pickup_ts"),
        ts("tpep_dropoff_datetime").alias("dropoff_ts"),
        to("VendorID", "int").alias("vendor_id"),
        to("RatecodeID", "int").alias("rate_code_id"),
        to("PULocationID", "int").alias("pickup_location_id"),
        to("DOLocationID", "int").alias("dropoff_location_id"),
        to("payment_type", "int").alias("payment_type"),
        to("passenger_count", "int").alias("passenger_count"),
        to("trip_distance", "double").alias("trip_distance"),
        to("fare_amount", "double").alias("fare_amount"),
        to("total_amount", "double").alias("total_amount"),
        "ingestion_timestamp",
        "batch_id",
        *carried,
    )


def with_timestamps(typed: DataFrame) -> DataFrame:
    """Rows with both timestamps; their month is then known too."""
    return typed.where(F.col("pickup_ts").isNotNull() & F.col("dropoff_ts").isNotNull())


def add_duration_speed(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_duration_minutes", tf.duration_minutes()).withColumn(
        "trip_speed_mph", tf.speed_mph()
    )


def enriched_trips(
    bronze: DataFrame,
    zones: DataFrame,
    months: list[str] | None = None,
    lenient: bool = False,
    carried: list[str] | tuple[str, ...] = tuple(PASSED_THROUGH),
    between: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Typed, deduplicated trips with derived columns and both zones, before filtering.

    Month, duration and speed follow from the dedup key, so they are added after
    the dedup: they do not travel through its shuffle, and filters on them are
    pushed below it. A caller that only judges rows passes `carried=[]` and halves
    the columns that do; the surviving copy has the same key, codes and amounts.
    `between` is applied to the trips before their zones are looked up.
    """
    typed = typed_trips(in_months(select_contract(bronze), "tpep_pickup_datetime", months), lenient, carried)
    trips = dedup_trips(with_timestamps(typed))
    trips = add_duration_speed(trips.withColumn("pickup_month", tf.month_key("pickup_ts")))
    return add_both_zones(between(trips) if between else trips, zones)


def silver_trips(
    bronze: DataFrame,
    zones: DataFrame,
    limits: TripLimits = TripLimits(),
    months: list[str] | None = None,
    lenient: bool = False,
    gather: bool = False,
) -> DataFrame:
    """The published silver relation. `zones` is the silver zone table.

    `gather` brings the rows of a month together, for a write by month. Rows are
    judged by all rules but that on zones before, and get their zones after it: the
    shuffle carries neither names nor rows that are dropped anyway.

    The rules stay after the dedup: one on a column outside the dedup key, moved
    before it, would let an older copy of a trip survive.
    """

    def gathered(trips: DataFrame) -> DataFrame:
        without_zones = tuple(name for name in trip_rules(limits) if name != "zone_integrity")
        return gather_months(keep_valid(trips, limits, without_zones), "pickup_month")

    kept = keep_valid(enriched_trips(bronze, zones, months, lenient, between=gathered if gather else None), limits)
    return kept.select(*schemas.names(schemas.SILVER_TRIP))


def silver_zones(bronze_zones: DataFrame) -> DataFrame:
    """Zones with a typed key and lower-case names, one row per location."""
    named = bronze_zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )
    return dedup_zones(named)
