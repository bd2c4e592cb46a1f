"""One query per operator, over the whole of the supplied tables.

A query name maps to a function of (spark, sf_dir). Averages and scores are
rounded to four decimals here, in the output only.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline import Lake, run_months, schemas
from kerbline.functions import trips as tf
from kerbline.functions.money import money_avg, money_sum
from kerbline.functions.months import explode_months, in_months, months_after, months_todo
from kerbline.operators import dedup, quality, spikes, zones
from kerbline.plans import bronze, gold, reports, silver
from kerbline.plans.incremental import land_trips
from kerbline.sinks import append_batch, replace_months, replace_table
from kerbline.sources.monthly import scan_months
from kerbline.sources.tables import load_table, only_months, register_views
from kerbline.sources.zones import scan_zone_csv
from workload import stage
from workload.relations import AIRPORT_FEE_SINCE, AIRPORTS, zones_raw

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared with the SQL checks.
FILTER_MONTHS = ["1995-03", "1995-04", "1997-11"]
REWRITE_SINCE = "1998-01"
EMPTIED_MONTH = "1996-05"
FIRST_RUN_UNTIL = "1999-07"

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 4) for name in columns})


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "yellow_trips")


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed_trips(_bronze(spark, sf_dir))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "silver_zones")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched trips without the columns no rule reads."""
    return silver.enriched_trips(_bronze(spark, sf_dir), _zones(spark, sf_dir), carried=[])


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "silver_trips")


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "fact_taxi_trips")


def _demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "demand_by_zone_hour_mart")


def _revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "revenue_by_borough_day_mart")


def _payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "payment_behavior_mart")


def _airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "airport_trip_mart")


def _efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.table(spark, sf_dir, "trip_efficiency_mart")


# -- scans ----------------------------------------------------------------


def _monthly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = stage.month_files(spark, sf_dir)
    return scan_months(spark, [files.format(month=month) for month in stage.month_list(spark, sf_dir)])


@query
def scan_monthly_parquet(spark, sf_dir):
    trips = _monthly_scan(spark, sf_dir).withColumn("file_month", tf.month_key("tpep_dropoff_datetime"))
    return trips.groupBy("file_month").agg(
        F.count("*").alias("trip_count"),
        money_sum("total_amount").alias("total_amount"),
        money_sum("fare_amount").alias("fare_amount"),
        F.count("Airport_fee").alias("airport_fee_rows"),
    )


@query
def schema_evolution_union(spark, sf_dir):
    return _monthly_scan(spark, sf_dir).select(
        "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount", "Airport_fee"
    )


@query
def bronze_trips_metadata(spark, sf_dir):
    stamped = bronze.stamp_load(_monthly_scan(spark, sf_dir), "trips", "b1")
    return stamped.select(
        "tpep_pickup_datetime",
        "total_amount",
        "source_name",
        "batch_id",
        F.element_at(F.split("source_file", "/"), -2).alias("source_folder"),
        F.col("ingestion_timestamp").isNotNull().alias("is_stamped"),
    )


@query
def bronze_with_added_column(spark, sf_dir):
    """Two loads, the second with a column that the contract does not know, read back through the lake."""
    lake = Lake(stage.scratch_path(spark, "added"))
    trips = _bronze(spark, sf_dir).select(*schemas.names(schemas.RAW_TRIP), "source_file", "batch_id")
    for batch_id in ("b1", "b2"):
        batch = trips.where(F.col("batch_id") == batch_id).drop("batch_id")
        if batch_id == "b2":
            batch = batch.withColumn("cbd_congestion_fee", F.col("total_amount") / 8)
        land_trips(batch, lake, "trips", batch_id)
    landed = lake.read(spark, "yellow_trips")
    return landed.select("batch_id", "tpep_pickup_datetime", "total_amount", "cbd_congestion_fee")


def _zone_csv_round_trip(spark, sf_dir):
    path = stage.scratch_path(spark, "zone_csv")
    zones_raw(spark, sf_dir).write.option("header", True).csv(path)
    return scan_zone_csv(spark, path)


_registry["scan_zone_csv"] = _zone_csv_round_trip


@query
def sql_over_views(spark, sf_dir):
    register_views({"revenue_by_borough_day_mart": _revenue(spark, sf_dir)})
    return spark.sql(
        """
        SELECT CAST(date_trunc('MONTH', trip_date) AS DATE) AS revenue_month, pickup_borough,
               SUM(trip_count) AS trip_count, ROUND(SUM(daily_revenue), 2) AS monthly_revenue
        FROM revenue_by_borough_day_mart
        GROUP BY 1, 2
        ORDER BY 1, 4 DESC, 2
        """
    )


@query
def month_range(spark, sf_dir):
    trips = _typed(spark, sf_dir).withColumn("month", tf.month_key("pickup_ts"))
    bounds = trips.groupBy("pickup_location_id").agg(
        F.min("month").alias("start_month"), F.max("month").alias("end_month")
    )
    return explode_months(bounds)


def _manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    delivered = stage.delivered_months(spark, sf_dir)
    bounds = delivered.agg(F.min("month").alias("start_month"), F.max("month").alias("end_month"))
    return explode_months(bounds), delivered.where(F.col("month") < AIRPORT_FEE_SINCE)


@query
def incremental_months_todo(spark, sf_dir):
    return months_todo(*_manifest(spark, sf_dir))


@query
def incremental_manifest_after(spark, sf_dir):
    requested, done = _manifest(spark, sf_dir)
    return months_after(done, months_todo(requested, done))


# -- sinks ----------------------------------------------------------------


@query
def sink_append_batches(spark, sf_dir):
    path = stage.scratch_path(spark, "append")
    trips = _bronze(spark, sf_dir).select(*schemas.names(schemas.RAW_TRIP), "batch_id")
    for batch, batch_id in (("b1", "20240101000000"), ("b2", "20240201000000")):
        append_batch(trips.where(F.col("batch_id") == batch).withColumn("batch_id", F.lit(batch_id)), path)
    table = load_table(spark, path, f"{schemas.RAW_TRIP}, batch_id string")
    return table.groupBy("batch_id", "payment_type").agg(
        F.count("*").alias("trip_count"), money_sum("total_amount").alias("total_amount")
    )


@query
def sink_full_overwrite(spark, sf_dir):
    path = stage.scratch_path(spark, "overwrite")
    replace_table(silver.silver_zones(zones_raw(spark, sf_dir)).withColumn("zone", F.lit("stale")), path)
    replace_table(silver.silver_zones(zones_raw(spark, sf_dir)), path)
    return load_table(spark, path, schemas.SILVER_ZONE)


@query
def sink_dynamic_overwrite(spark, sf_dir):
    path = stage.scratch_path(spark, "dynamic")
    demand = _demand(spark, sf_dir)
    replace_months(demand, path, "trip_month")
    later = demand.where(F.col("trip_month") >= REWRITE_SINCE)
    replace_months(later.withColumn("pickup_trip_count", F.col("pickup_trip_count") + 100), path, "trip_month")
    # A month whose new result has no rows is emptied.
    replace_months(demand.limit(0), path, "trip_month", months=[EMPTIED_MONTH])
    return load_table(spark, path, schemas.DEMAND_MART)


# -- projections ----------------------------------------------------------


@query
def project_bronze_columns(spark, sf_dir):
    # The load time and path differ from run to run.
    return silver.select_contract(_bronze(spark, sf_dir)).drop("ingestion_timestamp", "source_file")


@query
def cast_normalize_trips(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        *dedup.TRIP_KEY, "vendor_id", "rate_code_id", "payment_type", "passenger_count", "total_amount", "batch_id"
    )


@query
def fact_date_parts(spark, sf_dir):
    return gold.fact_trips(_silver(spark, sf_dir)).select(
        "pickup_ts", "dropoff_ts", "pickup_location_id", "trip_date", "trip_hour", "trip_month"
    )


@query
def trip_duration_speed(spark, sf_dir):
    return silver.add_duration_speed(_typed(spark, sf_dir)).select(
        "pickup_ts", "dropoff_ts", "trip_distance", "trip_duration_minutes", "trip_speed_mph"
    )


# -- zones ----------------------------------------------------------------


@query
def zones_silver(spark, sf_dir):
    return silver.silver_zones(zones_raw(spark, sf_dir))


@query
def dedup_zones(spark, sf_dir):
    return silver.silver_zones(stage.table(spark, sf_dir, "taxi_zones")).select("location_id", "borough", "zone")


@query
def dim_zones(spark, sf_dir):
    return stage.table(spark, sf_dir, "dim_taxi_zones")


@query
def zone_roles(spark, sf_dir):
    table = _zones(spark, sf_dir)
    by_role = zones.zone_role(table, "pickup").join(
        zones.zone_role(table, "dropoff"), F.col("pickup_location_id") == F.col("dropoff_location_id")
    )
    return by_role


# -- filters --------------------------------------------------------------


@query
def filter_run_months(spark, sf_dir):
    return in_months(_bronze(spark, sf_dir), "tpep_pickup_datetime", FILTER_MONTHS).select(
        "tpep_pickup_datetime", "PULocationID", "DOLocationID", "total_amount", "batch_id"
    )


@query
def filter_partition_months(spark, sf_dir):
    return only_months(_silver(spark, sf_dir), FILTER_MONTHS, "pickup_month").select(
        "pickup_month", "pickup_ts", "pickup_zone", "dropoff_zone", "total_amount"
    )


@query
def filter_valid_timestamps(spark, sf_dir):
    # The supplied rows all have timestamps; take some away by payment type and rate code.
    trips = _typed(spark, sf_dir)
    trips = trips.withColumn("pickup_ts", F.when(F.col("payment_type").isNotNull(), F.col("pickup_ts")))
    trips = trips.withColumn("dropoff_ts", F.when(F.col("rate_code_id") != 7, F.col("dropoff_ts")))
    return silver.with_timestamps(trips).select("pickup_ts", "dropoff_ts", "payment_type", "rate_code_id", "batch_id")


def _kept(trips: DataFrame, rule: str, *columns: str) -> DataFrame:
    return quality.keep_valid(trips, only=(rule,)).select(*columns)


@query
def keep_location_keys(spark, sf_dir):
    return _kept(
        _typed(spark, sf_dir), "null_key_identifiers", "pickup_ts", "pickup_location_id", "dropoff_location_id"
    )


@query
def keep_payment_types(spark, sf_dir):
    return _kept(_typed(spark, sf_dir), "payment_type_accepted", "pickup_ts", "payment_type", "total_amount")


@query
def keep_rate_codes(spark, sf_dir):
    return _kept(_typed(spark, sf_dir), "rate_code_accepted", "pickup_ts", "rate_code_id", "total_amount")


@query
def keep_time_order(spark, sf_dir):
    return _kept(_typed(spark, sf_dir), "timestamps_valid", "pickup_ts", "dropoff_ts", "total_amount")


@query
def keep_non_negative(spark, sf_dir):
    return _kept(_typed(spark, sf_dir), "non_negative_fare_distance", "pickup_ts", "fare_amount", "trip_distance")


@query
def keep_zone_resolved(spark, sf_dir):
    trips = zones.add_both_zones(_typed(spark, sf_dir), _zones(spark, sf_dir))
    return _kept(trips, "zone_integrity", "pickup_ts", "pickup_zone", "dropoff_zone", "total_amount")


@query
def keep_duration_speed(spark, sf_dir):
    trips = silver.add_duration_speed(_typed(spark, sf_dir))
    return _kept(trips, "duration_speed_anomaly", "pickup_ts", "trip_duration_minutes", "trip_speed_mph")


@query
def filter_airport_trips(spark, sf_dir):
    return gold.airport_trips(_fact(spark, sf_dir), AIRPORTS).select(
        "pickup_ts", "dropoff_ts", "pickup_zone", "dropoff_zone", "total_amount"
    )


# -- joins and dedup ------------------------------------------------------


@query
def enrich_pickup_zone(spark, sf_dir):
    trips = _typed(spark, sf_dir).select("pickup_ts", "pickup_location_id", "total_amount")
    return zones.add_zone(trips, _zones(spark, sf_dir), "pickup")


@query
def enrich_both_zones(spark, sf_dir):
    trips = _typed(spark, sf_dir).select("pickup_ts", "pickup_location_id", "dropoff_location_id", "total_amount")
    return zones.add_both_zones(trips, _zones(spark, sf_dir))


@query
def dedup_trips(spark, sf_dir):
    return dedup.dedup_trips(_typed(spark, sf_dir)).select(
        *dedup.TRIP_KEY, "total_amount", "payment_type", "rate_code_id", "vendor_id", "passenger_count", "batch_id"
    )


# -- quality --------------------------------------------------------------


@query
def dq_trip_checks(spark, sf_dir):
    return quality.check_trips(_judged(spark, sf_dir))


@query
def dq_silver_checks(spark, sf_dir):
    return quality.check_trips(_silver(spark, sf_dir))


@query
def dq_quarantine_counts(spark, sf_dir):
    rejected = quality.quarantine(_judged(spark, sf_dir))
    return rejected.select(F.explode("rejected_by").alias("rule")).groupBy("rule").agg(F.count("*").alias("row_count"))


# -- published relations --------------------------------------------------


@query
def silver_trips(spark, sf_dir):
    trips = silver.silver_trips(_bronze(spark, sf_dir), _zones(spark, sf_dir))
    return trips.drop("ingestion_timestamp", "source_file")


@query
def fact_trips(spark, sf_dir):
    return gold.fact_trips(_silver(spark, sf_dir)).drop("ingestion_timestamp", "source_file")


@query
def demand_by_zone_hour_mart(spark, sf_dir):
    return gold.demand_mart(_fact(spark, sf_dir))


@query
def revenue_by_borough_day_mart(spark, sf_dir):
    return gold.revenue_mart(gold.payment_days(_fact(spark, sf_dir)))


@query
def airport_trip_mart(spark, sf_dir):
    return gold.airport_mart(_fact(spark, sf_dir), AIRPORTS)


@query
def payment_behavior_mart(spark, sf_dir):
    return gold.payment_mart(gold.payment_days(_fact(spark, sf_dir)))


@query
def revenue_of_fine_amounts(spark, sf_dir):
    """Amounts with many digits behind the point, and one in a thousand that no decimal holds."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1000
    huge = (F.col("l_orderkey") % 1000 == 0) & (F.col("l_linestatus") == "F")
    lines = lines.withColumn("amount", F.when(huge, F.lit(1e20)).otherwise(amount))
    totals = lines.groupBy("l_returnflag", "l_linestatus").agg(
        money_sum("amount").alias("revenue"), money_avg("amount").alias("average")
    )
    return totals.withColumns({name: F.round(F.col(name), F.lit(4)) for name in ("revenue", "average")})


EFFICIENCY_AVERAGES = ["avg_trip_distance", "avg_trip_duration_minutes", "avg_fare_per_mile", "avg_fare_per_minute"]


@query
def trip_efficiency_mart(spark, sf_dir):
    """From the stored monthly parts, as a run builds it."""
    return rounded(gold.efficiency_mart(stage.table(spark, sf_dir, "trip_efficiency_parts")), *EFFICIENCY_AVERAGES)


@query
def trip_efficiency_parts(spark, sf_dir):
    sums = [f"{name}_sum" for name in ("distance", "duration", "mile_fare", "minute_fare")]
    return rounded(gold.efficiency_parts(_fact(spark, sf_dir)), *sums)


# -- reports --------------------------------------------------------------


@query
def report_hourly_demand(spark, sf_dir):
    return reports.hourly_demand(_demand(spark, sf_dir))


@query
def report_daily_revenue(spark, sf_dir):
    return reports.daily_revenue(_revenue(spark, sf_dir))


@query
def report_monthly_revenue(spark, sf_dir):
    return reports.monthly_revenue(_revenue(spark, sf_dir))


@query
def report_peak_zone_hour(spark, sf_dir):
    return reports.peak_zone_hours(_demand(spark, sf_dir))


@query
def report_distance_duration(spark, sf_dir):
    return rounded(reports.distance_duration(_efficiency(spark, sf_dir)), *EFFICIENCY_AVERAGES[:2])


@query
def report_airport_routes(spark, sf_dir):
    return reports.airport_routes(_airport(spark, sf_dir))


@query
def report_payment_trends(spark, sf_dir):
    return reports.payment_trends(_payment(spark, sf_dir))


@query
def report_zone_ranking(spark, sf_dir):
    return reports.zone_ranking(_demand(spark, sf_dir))


@query
def zone_daily_demand(spark, sf_dir):
    return spikes.zone_days(_demand(spark, sf_dir))


@query
def zone_demand_stats(spark, sf_dir):
    statistics = spikes.zone_statistics(spikes.zone_days(_demand(spark, sf_dir)))
    return rounded(statistics, "avg_pickups", "std_pickups")


@query
def report_demand_spikes(spark, sf_dir):
    return rounded(reports.spikes(_demand(spark, sf_dir)), "z_score")


@query
def dash_kpi_snapshot(spark, sf_dir):
    return reports.kpi_snapshot(_fact(spark, sf_dir))


@query
def dash_monthly_trips(spark, sf_dir):
    return reports.monthly_trips(_fact(spark, sf_dir))


@query
def dash_hourly_heatmap(spark, sf_dir):
    return reports.hourly_heatmap(_demand(spark, sf_dir))


@query
def dash_top_zones(spark, sf_dir):
    return reports.top_zones(_demand(spark, sf_dir))


@query
def dash_trip_efficiency(spark, sf_dir):
    return rounded(reports.trip_efficiency(_efficiency(spark, sf_dir)), *EFFICIENCY_AVERAGES)


@query
def dash_airport_revenue_rank(spark, sf_dir):
    return reports.airport_revenue_rank(_airport(spark, sf_dir))


@query
def nb_summary_metrics(spark, sf_dir):
    return reports.summary_metrics(_demand(spark, sf_dir), _revenue(spark, sf_dir))


@query
def nb_top_zone_hours(spark, sf_dir):
    return reports.top_zone_hours(_demand(spark, sf_dir))


@query
def nb_hourly_volume(spark, sf_dir):
    return reports.hourly_volume(_demand(spark, sf_dir))


@query
def nb_revenue_by_borough(spark, sf_dir):
    return reports.revenue_by_borough(_revenue(spark, sf_dir))


# -- the whole job --------------------------------------------------------


def incremental_lake(spark: SparkSession, sf_dir: str, runs: list[tuple[str, str]]) -> Lake:
    """A fresh lake after successive runs over the given month ranges."""
    zone_csv = stage.scratch_path(spark, "zones")
    zones_raw(spark, sf_dir).write.option("header", True).csv(zone_csv)
    lake = Lake(stage.scratch_path(spark, "lake"))
    for number, (start, end) in enumerate(runs, 1):
        run_months(
            spark, lake, start, end, stage.month_files(spark, sf_dir), zone_csv, f"run{number}", airports=AIRPORTS
        )
    return lake


@query
def pipeline_incremental(spark, sf_dir):
    # Every delivered month in two runs that overlap in July 1999, which the second one skips.
    months = stage.month_list(spark, sf_dir)
    runs = [(months[0], FIRST_RUN_UNTIL), (FIRST_RUN_UNTIL, months[-1])]
    return incremental_lake(spark, sf_dir, runs).read(spark, "demand_by_zone_hour_mart")
