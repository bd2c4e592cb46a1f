"""Layers stored once per session, so a query does its own layer's work only.

Silver queries read stored bronze, marts read the stored fact and reports read
the stored marts, as they do in production. Tables go to the shared folder named
in spark.checkpoint.dir, or where none is set to the warehouse, which is shared
storage too.
"""

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline import Lake, TripLimits
from kerbline.functions.trips import month_key
from kerbline.plans import bronze, silver
from kerbline.plans.incremental import TABLES, publish_gold, publish_silver
from kerbline.sinks import append_batch, gather_months, replace_table
from kerbline.sources.tables import bound_tasks
from workload.relations import AIRPORT_FEE_SINCE, AIRPORTS, bronze_batches, raw_trips, zones_raw

FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LINES_PER_PARTITION, MOST_PARTITIONS = 100_000, 4_000

_lock = threading.RLock()
_partitions: dict[tuple[str, str], int] = {}
_roots: dict[str, str] = {}
_built: set[tuple[str, str]] = set()
_tables: dict[tuple[str, str], DataFrame] = {}


def fit_tasks(spark: SparkSession, sf_dir: str) -> None:
    """From now on, tasks that sort trips get about as many of them however many there are: what a task takes is bounded, and
    a shuffle begins with a partition for so many line items (counted in the footers), which adaptive execution merges again
    where they are small. The settings stay: frames are lazy and run after the query has returned."""
    bound_tasks(spark)
    with _lock:
        key = (scratch_root(spark), sf_dir)
        if key not in _partitions:
            lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
            _partitions[key] = min(MOST_PARTITIONS, -(-lines // LINES_PER_PARTITION))
    spark.conf.unset(FIRST_PARTITIONS)
    if _partitions[key] > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_PARTITIONS, str(_partitions[key]))


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application's own under the shared scratch folder."""
    app = spark.sparkContext.applicationId
    with _lock:
        if app not in _roots:
            shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
            _roots[app] = f"{shared.rstrip('/')}/kerbline-{app}-{uuid.uuid4().hex[:8]}"
        return _roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one query's own output."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def _once(root: str, layer: str, build) -> None:
    with _lock:
        if (root, layer) not in _built:
            build()
            _built.add((root, layer))


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake(f"{scratch_root(spark)}/{sf_dir.strip('/').replace('/', '_')}")


def bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = _lake(spark, sf_dir)

    def build() -> None:
        rows = bronze_batches(raw_trips(spark, sf_dir))
        stamped = bronze.stamp_load(rows, "trips", F.col("batch_id"), f"{sf_dir}/lineitem.parquet")
        append_batch(stamped, lake.path("yellow_trips"))
        zones = bronze.stamp_load(zones_raw(spark, sf_dir), "zones", "b1", f"{sf_dir}/nation.parquet")
        replace_table(zones, lake.path("taxi_zones"))
        replace_table(silver.silver_zones(lake.read(spark, "taxi_zones")), lake.path("silver_zones"))
        replace_table(lake.read(spark, "silver_zones"), lake.path("dim_taxi_zones"))

    _once(lake.root, "bronze", build)
    return lake


def silver_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = bronze_lake(spark, sf_dir)
    _once(lake.root, "silver", lambda: publish_silver(spark, lake, TripLimits()))
    return lake


def gold_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = silver_lake(spark, sf_dir)
    _once(lake.root, "gold", lambda: publish_gold(spark, lake, airports=AIRPORTS))
    return lake


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table by name; its files are listed once per session, not once per query."""
    layer = "bronze" if name in ("silver_zones", "dim_taxi_zones") else TABLES[name][0]
    lake = {"bronze": bronze_lake, "silver": silver_lake, "gold": gold_lake}[layer](spark, sf_dir)
    with _lock:
        if (lake.root, name) not in _tables:
            _tables[lake.root, name] = lake.read(spark, name)
        return _tables[lake.root, name]


def month_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw trips as one folder of Parquet files per delivery month: a path with `{month}` in it.

    Files before 1998 lack the airport fee column.
    """
    root = f"{_lake(spark, sf_dir).root}/files"

    def build() -> None:
        # Trips are put together once; each kind of file is then cut from them.
        kept = f"{_lake(spark, sf_dir).root}/raw_trips"
        trips = raw_trips(spark, sf_dir).drop("l_linenumber")
        replace_table(trips, kept)
        raw = spark.read.schema(trips.schema).parquet(kept)
        early = F.col("file_month") < AIRPORT_FEE_SINCE
        for rows in (raw.where(early).drop("Airport_fee"), raw.where(~early)):
            gather_months(rows, "file_month").write.mode("append").partitionBy("file_month").parquet(root)

    _once(root, "files", build)
    return f"{root}/file_month={{month}}"


def delivered_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of every delivery file, from the stored bronze trips."""
    return table(spark, sf_dir, "yellow_trips").select(month_key("tpep_dropoff_datetime").alias("month")).distinct()


def month_list(spark: SparkSession, sf_dir: str) -> list[str]:
    """Every delivery month, in order: the names of the monthly folders, from which alone they are read."""
    root = month_files(spark, sf_dir).rsplit("/", 1)[0]
    folders = spark.read.schema("file_month string").parquet(root).select("file_month").distinct()
    return sorted(row.file_month for row in folders.collect())
