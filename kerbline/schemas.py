"""Column contracts of the stored tables, as DDL strings.

Stored tables are always read with their contract instead of an inferred
schema: no footer is opened to plan a scan, batches written before a column
existed read as NULL, and a digits-only partition value stays a string.
"""

# Business columns of a raw trip file. Counts and codes arrive as int, bigint
# or double depending on the month; these are the types they all widen to.
RAW_TRIP = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, PULocationID bigint, "
    "DOLocationID bigint, payment_type bigint, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double, Airport_fee double"
)
RAW_ZONE = "LocationID string, Borough string, Zone string, service_zone string"

# Stamped on every bronze row.
LOAD_STAMP = "ingestion_timestamp timestamp, source_name string, source_file string"

BRONZE_TRIP = f"{RAW_TRIP}, {LOAD_STAMP}, batch_id string"
BRONZE_ZONE = f"{RAW_ZONE}, {LOAD_STAMP}, batch_id string"

SILVER_ZONE = "location_id int, borough string, zone string, service_zone string"
_SILVER_BODY = (
    "passenger_count int, trip_distance double, payment_type int, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, Airport_fee double, "
    "ingestion_timestamp timestamp, source_name string, batch_id string, source_file string, "
    "pickup_ts timestamp, dropoff_ts timestamp, vendor_id int, rate_code_id int, "
    "pickup_location_id int, dropoff_location_id int, trip_duration_minutes double, "
    "trip_speed_mph double, pickup_borough string, pickup_zone string, pickup_service_zone string, "
    "dropoff_borough string, dropoff_zone string, dropoff_service_zone string"
)
SILVER_TRIP = f"{_SILVER_BODY}, pickup_month string"

FACT_TRIP = f"{_SILVER_BODY}, pickup_month string, trip_date date, trip_hour int, trip_month string"

DEMAND_MART = (
    "trip_date date, trip_hour int, pickup_location_id int, pickup_borough string, pickup_zone string, "
    "pickup_trip_count bigint, passenger_total bigint, trip_month string"
)
REVENUE_MART = (
    "trip_date date, pickup_borough string, daily_revenue double, daily_fare double, trip_count bigint, "
    "trip_month string"
)
AIRPORT_MART = "pickup_zone string, dropoff_zone string, trip_count bigint, revenue double, trip_month string"
PAYMENT_MART = (
    "trip_date date, pickup_borough string, payment_type int, trip_count bigint, total_revenue double, "
    "trip_month string"
)
EFFICIENCY_MART = (
    "pickup_borough string, avg_trip_distance double, avg_trip_duration_minutes double, "
    "avg_fare_per_mile double, avg_fare_per_minute double"
)
# Sums and counts per month from which the efficiency mart is averaged.
EFFICIENCY_PARTS = (
    "pickup_borough string, distance_sum double, distance_n bigint, duration_sum double, duration_n bigint, "
    "mile_fare_sum double, mile_fare_n bigint, minute_fare_sum double, minute_fare_n bigint, trip_month string"
)
MONTHS_DONE = "month string"
# Columns that deliveries added to the contract of bronze trips.
ADDED_COLUMNS = "name string, kind string"
BATCH_MONTHS = "batch_id string, month string"


def names(ddl: str) -> list[str]:
    """Column names of a contract, in order."""
    return [column.split()[0] for column in ddl.split(", ")]
