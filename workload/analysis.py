"""Queries beyond the published tables and reports: moving frames, time joins, subtotals, sketches, streams, upserts.

Each has its SQL in analysis_sql.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.functions.money import money_sum
from kerbline.operators import intervals, moving, rollup, sketches, spells, spikes
from kerbline.operators.asof import asof_join
from kerbline.operators.upsert import upsert_months
from kerbline.plans import comparisons
from kerbline.sinks import replace_months
from kerbline.sinks.bucketed import write_bucketed
from kerbline.sources.tables import load_table
from kerbline.streaming import hourly
from workload import stage
from workload.queries import rounded

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared with the SQL: zone names change four times, 500 days apart, from a day of their own on.
NAME_CHANGES = 4
FIRST_NAMES = 707_356_800  # 1992-06-01
OVERLAP_BIN_SECONDS = 3600
SPELL_GAP_SECONDS = 1800
CORRECTED_MONTHS = ("1995-03", "1997-11")
BUCKETS = 8
# Four standard errors of a distinct sketch, and twice the rank error of a quantile sketch.
DISTINCT_ERROR, QUANTILE_ERROR = 0.065, 0.033
SKETCHES = "row_count bigint, distinct_sketch binary, value_sketch binary, trip_month string"

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _table(name: str) -> Query:
    return lambda spark, sf_dir: stage.table(spark, sf_dir, name)


_fact, _demand, _revenue, _payment, _zones = map(
    _table, ("fact_taxi_trips", "demand_by_zone_hour_mart", "revenue_by_borough_day_mart", "payment_behavior_mart", "silver_zones")
)


# -- window frames --------------------------------------------------------


@query
def moving_zone_demand(spark, sf_dir):
    """Seven-day demand of every calendar day of a zone, days without a pickup among them."""
    days = moving.calendar_days(spikes.zone_days(_demand(spark, sf_dir)), ["pickup_zone"], ["pickups"])
    return rounded(moving.moving_measure(days, ["pickup_zone"], "pickups"), "moving_avg")


@query
def moving_demand_of_days_with_pickups(spark, sf_dir):
    days = spikes.zone_days(_demand(spark, sf_dir))
    return rounded(moving.moving_measure(days, ["pickup_zone"], "pickups", span=28), "moving_avg")


@query
def borough_month_to_date(spark, sf_dir):
    days = _revenue(spark, sf_dir).select("trip_date", "trip_month", "pickup_borough", "daily_revenue")
    return rounded(moving.running_amount(days, ["pickup_borough", "trip_month"], "daily_revenue"), "share_of_whole")


# -- as-of join -----------------------------------------------------------


def zone_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated lookup: the names a zone had, each valid from an instant on."""
    number, zone = F.col("number"), F.col("location_id")
    since = F.lit(FIRST_NAMES) + (zone * 53 + number * 500) * 86_400 + zone * 3600 + number * 17
    names = _zones(spark, sf_dir).withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(NAME_CHANGES - 1))))
    return names.select(
        F.col("location_id").alias("pickup_location_id"),
        F.concat_ws("/", "zone", "number").alias("zone_then"),
        F.timestamp_seconds(since).alias("valid_from"),
    )


def _trip_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir).select("pickup_ts", "dropoff_ts", "pickup_location_id", "fare_amount", "trip_distance")


@query
def asof_zone_names(spark, sf_dir):
    trips, names = _trip_times(spark, sf_dir), zone_names(spark, sf_dir)
    return asof_join(trips, names, ["pickup_location_id"], "pickup_ts", "valid_from", ["zone_then", "valid_from"])


@query
def asof_recent_zone_names(spark, sf_dir):
    """Names at most 200 days old, in ranges of a day."""
    trips, names = _trip_times(spark, sf_dir), zone_names(spark, sf_dir)
    dated = asof_join(trips, names, ["pickup_location_id"], "pickup_ts", "valid_from", ["zone_then"], 86_400, 200 * 86_400)
    return dated.groupBy("zone_then").agg(F.count("*").alias("trips"), money_sum("fare_amount").alias("fares"))


# -- interval join --------------------------------------------------------


@query
def overlapping_trips(spark, sf_dir):
    """Pairs of trips under way at once from the same zone, per zone and day on which the overlap begins."""
    trips = _fact(spark, sf_dir).select(
        "pickup_location_id", "pickup_ts", "dropoff_ts", F.struct("pickup_ts", "dropoff_ts", "dropoff_location_id", "fare_amount", "trip_distance").alias("trip")
    )
    span = ("pickup_ts", "dropoff_ts")
    pairs = intervals.overlapping_pairs(
        trips, trips, ["pickup_location_id"], span, span, OVERLAP_BIN_SECONDS, F.col("left.trip") < F.col("right.trip")
    )
    return pairs.groupBy(F.col("left.pickup_location_id").alias("pickup_location_id"), F.to_date("overlap_start").alias("trip_date")).agg(
        F.count("*").alias("pairs"), F.sum(F.col("overlap_seconds").cast("bigint")).alias("overlap_seconds")
    )


@query
def zone_concurrency(spark, sf_dir):
    """Most trips under way at once, and pairs that begin to overlap, per zone and day, from the events alone."""
    moments = intervals.under_way(_fact(spark, sf_dir), ["pickup_location_id"], ("pickup_ts", "dropoff_ts"))
    return moments.groupBy("pickup_location_id", F.to_date("instant").alias("trip_date")).agg(
        F.max("after").alias("peak"), F.sum(intervals.pairs_begun()).alias("pairs"), F.sum("begun").alias("begun")
    )


# -- several groupings at once --------------------------------------------


def _money_and_trips():
    return [money_sum("total_revenue").alias("revenue"), F.sum("trip_count").alias("trips")]


@query
def revenue_rollup(spark, sf_dir):
    levels = rollup.rollup_levels(["trip_month", "pickup_borough", "payment_type"])
    return rollup.subtotals(_payment(spark, sf_dir), levels, _money_and_trips())


@query
def revenue_grouping_sets(spark, sf_dir):
    levels = [["pickup_borough", "payment_type"], ["trip_month", "payment_type"], ["pickup_borough"], []]
    return rollup.subtotals(_payment(spark, sf_dir), levels, _money_and_trips())


@query
def payments_side_by_side(spark, sf_dir):
    return rollup.side_by_side(
        _payment(spark, sf_dir), ["trip_month", "pickup_borough"], "payment_type", [1, 2, 3, 4, 5, 6], F.sum("trip_count"), "trips_of_"
    )


# -- sketches -------------------------------------------------------------


@query
def sketched_months(spark, sf_dir):
    """Distinct route days and fare quartiles of each year from stored monthly sketches, held against exact values."""
    path = stage.scratch_path(spark, "sketches")
    counted = ["pickup_location_id", "dropoff_location_id", "trip_date"]
    fact = _fact(spark, sf_dir)
    replace_months(sketches.month_sketches(fact, ["trip_month"], counted, "fare_amount"), path, "trip_month")
    stored = load_table(spark, path, SKETCHES)
    year = F.substring("trip_month", 1, 4).alias("year")
    found = sketches.estimates(sketches.merged(stored, [year]), [0.25, 0.5, 0.75])
    trips = fact.select(year, *counted, "fare_amount").join(found.select("year", "quantiles"), "year")
    below = [F.avg((F.col("fare_amount") <= F.get("quantiles", i)).cast("int")).alias(f"below_{i}") for i in range(3)]
    upto = [F.avg((F.col("fare_amount") < F.get("quantiles", i)).cast("int")).alias(f"upto_{i}") for i in range(3)]
    exact = trips.groupBy("year").agg(F.countDistinct(*counted).alias("route_days"), *below, *upto)
    near = F.lit(True)
    for i, rank in enumerate((0.25, 0.5, 0.75)):
        near = near & (F.col(f"below_{i}") >= rank - QUANTILE_ERROR) & (F.col(f"upto_{i}") <= rank + QUANTILE_ERROR)
    return found.join(exact, "year").select(
        "year",
        "row_count",
        "route_days",
        (F.abs(F.col("distinct_estimate") - F.col("route_days")) <= DISTINCT_ERROR * F.col("route_days")).alias("distinct_near"),
        near.alias("quartiles_near"),
    )


# -- streams and sessions -------------------------------------------------


@query
def stream_hourly_demand(spark, sf_dir):
    """The delivered files as a stream, in two or more batches; nothing is late enough to be dropped."""
    stage.bronze_lake(spark, sf_dir)
    folder = stage.month_files(spark, sf_dir).rsplit("/", 1)[0]
    path = stage.scratch_path(spark, "hours")
    hourly.run_available(spark, folder, path, stage.scratch_path(spark, "checkpoint"), "20000 days", files_per_batch=60)
    return load_table(spark, path, hourly.HOURLY)


@query
def zone_busy_spells(spark, sf_dir):
    trips = _fact(spark, sf_dir)
    return spells.spells_of_instants(trips, ["pickup_zone"], "pickup_ts", SPELL_GAP_SECONDS, "passenger_count")


# -- subqueries -----------------------------------------------------------


@query
def zones_above_borough_mean(spark, sf_dir):
    return comparisons.zones_above_borough_mean(_demand(spark, sf_dir))


@query
def zones_with_airport_route(spark, sf_dir):
    return comparisons.zones_with_airport_route(_zones(spark, sf_dir), stage.table(spark, sf_dir, "airport_trip_mart"), 2)


@query
def days_without_card_payment(spark, sf_dir):
    return comparisons.days_without_payment(_payment(spark, sf_dir), 1)


@query
def days_above_week_before(spark, sf_dir):
    return comparisons.days_above_all_of_week_before(spikes.zone_days(_demand(spark, sf_dir)))


# -- buckets and corrections ----------------------------------------------


def bucketed_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fact and demand mart bucketed by pickup zone."""
    made = []
    for name, source in (("fact", _fact(spark, sf_dir)), ("demand", _demand(spark, sf_dir))):
        path = stage.scratch_path(spark, f"bucketed_{name}")
        made.append(write_bucketed(source, path.rsplit("/", 1)[1].replace("-", "_"), path, "pickup_location_id", BUCKETS))
    return made[0], made[1]


@query
def bucketed_zone_shares(spark, sf_dir):
    """Each zone's trips, its busiest hour and fares, from two bucketed tables."""
    fact, demand = bucketed_tables(spark, sf_dir)
    trips = fact.groupBy("pickup_location_id").agg(F.count("*").alias("trips"), money_sum("fare_amount").alias("fares"))
    busiest = demand.groupBy("pickup_location_id").agg(F.max("pickup_trip_count").alias("busiest_hour"))
    return trips.hint("merge").join(busiest, "pickup_location_id")


@query
def upsert_corrections(spark, sf_dir):
    """The demand mart after corrections of two months: changed, removed and new rows, some corrected twice."""
    path = stage.scratch_path(spark, "corrected")
    demand = _demand(spark, sf_dir)
    replace_months(demand, path, "trip_month")
    rows = demand.where(F.col("trip_month").isin(*CORRECTED_MONTHS) & (F.col("pickup_location_id") % 3 == 0))
    count = F.col("pickup_trip_count")
    first = rows.withColumns({"pickup_trip_count": count + 1000, "gone": F.col("trip_hour") == 5, "at": F.lit(1)})
    second = rows.where("trip_hour = 7").withColumns({"pickup_trip_count": count + 2000, "gone": F.lit(False), "at": F.lit(2)})
    new = rows.where("trip_hour = 9").withColumns({"trip_hour": F.lit(33), "gone": F.lit(False), "at": F.lit(1)})
    corrections = first.unionByName(second).unionByName(new)
    keys = ["trip_date", "trip_hour", "pickup_location_id"]
    upsert_months(corrections, path, schemas.DEMAND_MART, keys, [F.desc("at")], "trip_month", "trip_date", "gone")
    return load_table(spark, path, schemas.DEMAND_MART)
