"""The month-incremental run: from monthly files to published marts."""

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.functions import trips as tf
from kerbline.functions.months import explode_months, months_todo
from kerbline.operators.quality import TripLimits, require_valid
from kerbline.plans import bronze, gold, silver
from kerbline.sinks import append_batch, gather_months, replace_months, replace_table
from kerbline.sources.monthly import scan_months
from kerbline.sources.tables import bounded_tasks, load_table, only_months
from kerbline.sources.zones import scan_zone_csv

# Source names stamped on bronze rows unless the caller gives others.
TRIP_SOURCE = "nyc_tlc_yellow_trips"
ZONE_SOURCE = "nyc_tlc_taxi_zone_lookup"

# Table name -> (layer, column contract).
TABLES = {
    "yellow_trips": ("bronze", schemas.BRONZE_TRIP),
    "taxi_zones": ("bronze", schemas.BRONZE_ZONE),
    "months_done": ("state", schemas.MONTHS_DONE),
    "batch_months": ("state", schemas.BATCH_MONTHS),
    "added_columns": ("state", schemas.ADDED_COLUMNS),
    "silver_trips": ("silver", schemas.SILVER_TRIP),
    "silver_zones": ("silver", schemas.SILVER_ZONE),
    "dim_taxi_zones": ("gold", schemas.SILVER_ZONE),
    "fact_taxi_trips": ("gold", schemas.FACT_TRIP),
    "demand_by_zone_hour_mart": ("gold", schemas.DEMAND_MART),
    "revenue_by_borough_day_mart": ("gold", schemas.REVENUE_MART),
    "airport_trip_mart": ("gold", schemas.AIRPORT_MART),
    "payment_behavior_mart": ("gold", schemas.PAYMENT_MART),
    "trip_efficiency_parts": ("gold", schemas.EFFICIENCY_PARTS),
    "trip_efficiency_mart": ("gold", schemas.EFFICIENCY_MART),
}
PUBLISHED = [
    "dim_taxi_zones",
    "fact_taxi_trips",
    "demand_by_zone_hour_mart",
    "revenue_by_borough_day_mart",
    "airport_trip_mart",
    "payment_behavior_mart",
    "trip_efficiency_mart",
]


@dataclass(frozen=True)
class Lake:
    """Where the tables live: a root on shared storage and a table format."""

    root: str
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table][0]}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        contract = TABLES[table][1]
        if table == "yellow_trips":
            contract += "".join(f", `{name}` {kind}" for name, kind in sorted(self.added_columns(spark).items()))
        return load_table(spark, self.path(table), contract, self.fmt)

    def added_columns(self, spark: SparkSession) -> dict[str, str]:
        """Columns of landed trips beyond the contract, by name: one short row for each ever added."""
        return {row.name: row.kind for row in _state(spark, self, "added_columns").distinct().collect()}

    def published(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The gold tables by name, ready for `register_views`."""
        return {name: self.read(spark, name) for name in PUBLISHED}


@dataclass
class RunReport:
    requested: tuple[str, str]
    loaded: list[str] = field(default_factory=list)


@contextmanager
def session_zone(spark: SparkSession, zone: str) -> Iterator[None]:
    """Plan under a session time zone and put the previous one back.

    Dates, hours, months and durations of zone-less timestamps follow it.
    """
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _state(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """A state table; empty before anything was recorded."""
    try:
        return lake.read(spark, table)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "DELTA_TABLE_NOT_FOUND"):
            raise
        return spark.createDataFrame([], TABLES[table][1])


def months_done(spark: SparkSession, lake: Lake) -> DataFrame:
    """Months finished by earlier runs; none before the first run."""
    return _state(spark, lake, "months_done").distinct()


def note_added_columns(trips: DataFrame, lake: Lake) -> None:
    """Record the columns of a delivery that neither the contract nor an earlier delivery has.

    A known one must keep its type: stored files of two types cannot be read as one column.
    """
    spark = trips.sparkSession
    known = {name.lower() for name in schemas.names(schemas.BRONZE_TRIP)}
    before = {name.lower(): kind for name, kind in lake.added_columns(spark).items()}
    new = []
    for column in trips.schema:
        name, kind = column.name.lower(), column.dataType.simpleString()
        if name in known:
            continue
        if name not in before:
            new.append((column.name, kind))
        elif before[name] != kind:
            raise ValueError(f"column {column.name} was delivered as {before[name]} before and is {kind} now")
    if new:
        frame = spark.createDataFrame(new, schemas.ADDED_COLUMNS).coalesce(1)
        frame.write.format(lake.fmt).mode("append").save(lake.path("added_columns"))


def run_together(spark: SparkSession, *actions: Callable[[], None]) -> None:
    """Submit independent jobs at once; raise if any of them failed."""
    with ThreadPoolExecutor(len(actions)) as pool:
        for job in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]:
            job.result()


def land_trips(trips: DataFrame, lake: Lake, source_name: str, batch_id: str) -> None:
    """Append a batch of scanned trips to bronze; every load into a lake goes through here.

    The pickup months the batch holds are recorded first, one row each: a batch
    noted but missing from bronze costs nothing, one in bronze but not noted
    would be overlooked by later runs.
    """
    note_added_columns(trips, lake)
    month = tf.month_key(F.to_date("tpep_pickup_datetime"))
    held = trips.select(F.lit(batch_id).alias("batch_id"), month.alias("month")).distinct()
    held.write.format(lake.fmt).mode("append").save(lake.path("batch_months"))
    append_batch(bronze.stamp_load(trips, source_name, batch_id), lake.path("yellow_trips"), "batch_id", lake.fmt)


def batches_holding(spark: SparkSession, lake: Lake, months: list[str]) -> list[str]:
    """The batches with trips of these months: as many short ids as there were such loads."""
    held = lake.read(spark, "batch_months").where(F.col("month").isin(months))
    return sorted(row.batch_id for row in held.select("batch_id").distinct().collect())


def put_months(df: DataFrame, path: str, column: str, months: list[str] | None, gather: bool, fmt: str) -> None:
    """Replace the given months of a table, also those that have no row any more, or all of it."""
    if months:
        replace_months(df, path, column, gather, fmt, months)
    else:
        replace_table(gather_months(df, column) if gather else df, path, fmt, column)


def publish_silver(
    spark: SparkSession,
    lake: Lake,
    limits: TripLimits,
    months: list[str] | None = None,
    lenient: bool = False,
    batches: list[str] | None = None,
    gather: bool = True,
) -> None:
    """Rebuild the silver months from bronze, replacing only those months.

    `gather` brings the rows of a month together before the write, at the price of
    a second shuffle of full rows. Without it every task writes a file for each
    month it has rows of: right for passes over a few months.

    A month's trips may sit in any batch. `batches` names the ones that hold some;
    the others' folders are then not opened. Without it all of bronze is read.
    """
    bronze_trips = lake.read(spark, "yellow_trips")
    if batches is not None:
        bronze_trips = bronze_trips.where(F.col("batch_id").isin(batches))
    trips = silver.silver_trips(bronze_trips, lake.read(spark, "silver_zones"), limits, months, lenient, gather)
    with bounded_tasks(spark):
        put_months(trips, lake.path("silver_trips"), "pickup_month", months, False, lake.fmt)


def publish_gold(
    spark: SparkSession,
    lake: Lake,
    months: list[str] | None = None,
    airports: tuple[str, ...] = gold.AIRPORTS,
    gather: bool = True,
) -> None:
    """Write the fact once, then build each mart from the written fact.

    The fact is written straight from the scan, which already comes month by
    month. Reading back costs each mart only its own columns and months. The marts do
    not depend on each other, so their jobs are submitted together and one's last
    tasks do not leave the cluster idle. The efficiency mart covers all months
    and is averaged from its stored monthly parts.
    """

    def put(mart: DataFrame, table: str) -> None:
        put_months(mart, lake.path(table), "trip_month", months, gather, lake.fmt)

    trips = only_months(lake.read(spark, "silver_trips"), months, "pickup_month")
    with bounded_tasks(spark):
        put_months(gold.fact_trips(trips), lake.path("fact_taxi_trips"), "trip_month", months, False, lake.fmt)

    fact = only_months(lake.read(spark, "fact_taxi_trips"), months, "trip_month")

    def payments_and_revenue() -> None:
        days = gold.payment_days(fact).persist()
        try:
            put(gold.payment_mart(days), "payment_behavior_mart")
            put(gold.revenue_mart(days), "revenue_by_borough_day_mart")
        finally:
            days.unpersist()

    def efficiency() -> None:
        put(gold.efficiency_parts(fact), "trip_efficiency_parts")
        mart = gold.efficiency_mart(lake.read(spark, "trip_efficiency_parts"))
        replace_table(mart, lake.path("trip_efficiency_mart"), lake.fmt)

    run_together(
        spark,
        lambda: put(gold.demand_mart(fact), "demand_by_zone_hour_mart"),
        lambda: put(gold.airport_mart(fact, airports), "airport_trip_mart"),
        payments_and_revenue,
        efficiency,
    )


def run_months(
    spark: SparkSession,
    lake: Lake,
    start: str,
    end: str,
    trip_files: str,
    zone_csv: str,
    batch_id: str,
    limits: TripLimits = TripLimits(),
    airports: tuple[str, ...] = gold.AIRPORTS,
    zone: str = "UTC",
    trip_source: str = TRIP_SOURCE,
    zone_source: str = ZONE_SOURCE,
    lenient: bool = False,
    recheck_all_months: bool = False,
    months_per_pass: int | None = None,
    gather: bool = True,
) -> RunReport:
    """Load the months of start..end that no earlier run finished.

    `trip_files` is a path with `{month}` in it. Zones and the dimension are
    refreshed on every run. Trips of other months found in the new files wait in
    bronze until their own month is run. The gate reads the months just written,
    or the whole silver table with `recheck_all_months`. Months are recorded as
    done last, after gold: a run that fails is simply run again, and the rows it
    already appended to bronze are duplicates that the later batch replaces.

    `months_per_pass` builds and records a long range in slices once all its files
    are in bronze: no shuffle is larger than a slice, and a failure costs one
    slice. Each slice's files land as a batch of their own, its number behind the
    batch id, so a slice opens the files of the few batches that hold its months.
    The dedup key holds the pickup time, so slices give the same tables; of copies
    in files of two slices the later one's survives.
    `gather` is that of `publish_silver`; switch it off for passes of one to three
    months.
    """
    report = RunReport((start, end))
    with session_zone(spark, zone):
        bounds = spark.range(1).select(F.lit(start).alias("start_month"), F.lit(end).alias("end_month"))
        todo = months_todo(explode_months(bounds), months_done(spark, lake))
        # The work list is one short row per month and names the files to open.
        months = sorted(row.month for row in todo.collect())

        size = months_per_pass or max(len(months), 1)
        parts = [months[i : i + size] for i in range(0, len(months), size)]
        for number, part in enumerate(parts, 1):
            files = scan_months(spark, [trip_files.format(month=month) for month in part], lenient=lenient)
            land_trips(files, lake, trip_source, batch_id if len(parts) == 1 else f"{batch_id}-{number:04d}")

        lookup = bronze.stamp_load(scan_zone_csv(spark, zone_csv), zone_source, batch_id, zone_csv)
        replace_table(lookup, lake.path("taxi_zones"), lake.fmt)
        replace_table(silver.silver_zones(lake.read(spark, "taxi_zones")), lake.path("silver_zones"), lake.fmt)
        replace_table(lake.read(spark, "silver_zones"), lake.path("dim_taxi_zones"), lake.fmt)

        for part in parts:
            publish_silver(spark, lake, limits, part, lenient, batches_holding(spark, lake, part), gather)
            written = lake.read(spark, "silver_trips")
            require_valid(only_months(written, None if recheck_all_months else part, "pickup_month"), limits)
            publish_gold(spark, lake, part, airports, gather)
            finished = spark.createDataFrame([(month,) for month in part], schemas.MONTHS_DONE)
            finished.coalesce(1).write.format(lake.fmt).mode("append").save(lake.path("months_done"))
            report.loaded += part
    return report
