"""Trip and zone relations over the supplied order tables.

One trip per line item: the customer's nation is the pickup location, the
supplier's nation the dropoff location, the order date plus a number of seconds
derived from the keys the pickup time. FIXTURES.md gives every column.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline import schemas

# Fixed values of the mapping.
AIRPORTS = ("NATION_3", "NATION_7", "NATION_11")
UNLISTED_NATION = 24
AIRPORT_FEE_SINCE = "1998-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is_multiple(column: str, n: int):
    return F.col(column) % n == 0


def _round_cents(amount):
    """Two decimals by scaling, adding a half and flooring: ties fall as they do in DuckDB's round()."""
    return F.floor(amount * 100.0 + 0.5) / 100.0


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips plus `l_linenumber` and `file_month`, the month of the file a row is delivered in."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers before the many line items come in, which then travel once.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    rows = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    start_s = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 86400
    length_s = (
        F.when(_is_multiple("l_partkey", 97), 30000).otherwise(0)
        + (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17) % 5400
        - 60
    )
    rate = F.when(F.col("l_suppkey") % 50 == 7, 7.0).otherwise(
        F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 2.0).otherwise(99.0)
    )
    payment = F.when(_is_multiple("l_orderkey", 307), None).otherwise(
        F.when((F.col("o_orderstatus") == "P") & (F.col("l_linenumber") == 7), 0).otherwise(
            F.substring("o_orderpriority", 1, 1).cast("bigint")
        )
    )
    rows = rows.withColumns(
        {
            "pickup": F.timestamp_add("SECOND", start_s, "o_orderdate"),
            "dropoff": F.timestamp_add("SECOND", start_s + length_s, "o_orderdate"),
        }
    )
    return rows.select(
        (F.col("l_linenumber") % 2 + 1).cast("bigint").alias("VendorID"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        F.col("dropoff").alias("tpep_dropoff_datetime"),
        (F.col("l_quantity").cast("bigint") % 6 + 1).cast("double").alias("passenger_count"),
        (F.when(_is_multiple("l_partkey", 101), -1.0).otherwise(1.0) * F.col("l_quantity") / 4.0).alias(
            "trip_distance"
        ),
        rate.alias("RatecodeID"),
        F.when(~_is_multiple("l_orderkey", 211), F.col("c_nationkey")).cast("bigint").alias("PULocationID"),
        F.col("s_nationkey").cast("bigint").alias("DOLocationID"),
        payment.cast("bigint").alias("payment_type"),
        (
            F.when(_is_multiple("l_partkey", 103), -1.0).otherwise(1.0)
            * _round_cents(F.col("l_extendedprice") / 1000.0)
        ).alias("fare_amount"),
        (F.col("l_linenumber") % 3 * 0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_tax").alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        _round_cents(F.col("l_extendedprice") / 1000.0 * (1.0 + F.col("l_tax"))).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("Airport_fee"),
        "l_linenumber",
        F.date_format("dropoff", "yyyy-MM").alias("file_month"),
    )


def bronze_batch(raw: DataFrame, batch_id: str) -> DataFrame:
    """Batch b1 is every trip; b2 delivers line 1 again with a higher total."""
    if batch_id == "b2":
        raw = raw.where(F.col("l_linenumber") == 1).withColumn("total_amount", F.col("total_amount") + 1.0)
    return raw.select(*schemas.names(schemas.RAW_TRIP))


def bronze_batches(raw: DataFrame) -> DataFrame:
    """Both batches with their `batch_id`, from one pass over the trips."""
    held = F.when(F.col("l_linenumber") == 1, F.array(F.lit("b1"), F.lit("b2"))).otherwise(F.array(F.lit("b1")))
    rows = raw.withColumn("batch_id", F.explode(held))
    total = F.when(F.col("batch_id") == "b2", F.col("total_amount") + 1.0).otherwise(F.col("total_amount"))
    return rows.withColumn("total_amount", total).select(*schemas.names(schemas.RAW_TRIP), "batch_id")


def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup as text, with one nation unlisted and one location listed twice."""
    nations = _table(spark, sf_dir, "nation").where(F.col("n_nationkey") != UNLISTED_NATION)
    regions = _table(spark, sf_dir, "region")
    names = F.when(F.col("n_nationkey") == 3, F.array("n_name", F.concat("n_name", F.lit("_OLD")))).otherwise(
        F.array("n_name")
    )
    rows = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).withColumn("Zone", F.explode(names))
    return rows.select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        "Zone",
        F.concat(F.lit("Z"), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )
