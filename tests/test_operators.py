"""Dedup, zone joins, ranks and spikes against brute force on small fixtures."""

from collections import defaultdict
from statistics import fmean, pstdev

import pytest
from pyspark.sql import functions as F

from kerbline.operators.dedup import TRIP_KEY, dedup_trips
from kerbline.operators.ranking import dense_rank_desc, top_dense_rank
from kerbline.operators.spikes import demand_spikes
from kerbline.operators.zones import add_both_zones
from kerbline.plans.silver import silver_zones

TRIPS = (
    "pickup_ts int, dropoff_ts int, pickup_location_id int, dropoff_location_id int, fare_amount double, "
    "trip_distance double, batch_id string, total_amount double, payment_type int, rate_code_id int, "
    "vendor_id int, passenger_count int, extra double"
)


def _key(n):
    return (n, n + 1, n % 3, None if n % 2 else 4, float(n), 1.0)


def test_dedup_survivor_and_null_keys(spark):
    rows = [
        (*_key(1), "b1", 9.0, 1, 1, 1, 1, 0.0),
        (*_key(1), "b2", 3.0, 2, 1, 1, 1, 0.0),
        (*_key(1), "b2", 5.0, 2, 2, 1, 1, 0.0),
        (*_key(1), "b2", 5.0, 2, 1, 1, 1, 0.0),
        (*_key(1), "b2", None, 1, 1, 1, 1, 0.0),
        (*_key(2), "b1", 1.0, None, 1, 1, 1, 0.0),
        (*_key(2), "b1", 1.0, 4, 1, 1, 1, 0.0),
    ]
    kept = {row.pickup_ts: row for row in dedup_trips(spark.createDataFrame(rows, TRIPS)).collect()}
    assert len(kept) == 2
    assert (kept[1].batch_id, kept[1].total_amount, kept[1].rate_code_id) == ("b2", 5.0, 1)
    assert kept[2].payment_type == 4


def test_dedup_of_a_key_holding_a_third_of_all_rows(spark):
    spread = spark.range(6000).withColumn("n", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int"))
    trips = spread.select(
        F.col("n").alias("pickup_ts"),
        F.col("n").alias("dropoff_ts"),
        F.lit(None).cast("int").alias("pickup_location_id"),
        F.lit(1).alias("dropoff_location_id"),
        F.lit(1.0).alias("fare_amount"),
        F.lit(1.0).alias("trip_distance"),
        F.lit("b1").alias("batch_id"),
        F.col("id").cast("double").alias("total_amount"),
        *[F.lit(1).alias(c) for c in ("payment_type", "rate_code_id", "vendor_id", "passenger_count")],
    ).repartition(8)
    kept = dedup_trips(trips)
    assert kept.count() == trips.select(*TRIP_KEY).distinct().count()
    assert kept.where("pickup_ts = 7").first().total_amount == 5998.0 - 1


def test_zone_dedup_picks_the_smallest(spark):
    rows = [("3", "B", "Z", "s"), ("3", "A", "Y", "s"), ("3", "A", "X", "t"), ("4", None, None, None)]
    raw = spark.createDataFrame(rows, "LocationID string, Borough string, Zone string, service_zone string")
    kept = sorted(map(tuple, silver_zones(raw).collect()))
    assert kept == [(3, "A", "X", "t"), (4, None, None, None)]


@pytest.fixture
def conf(spark):
    changed = {}

    def change(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_zone_join_is_the_same_without_broadcast(spark, conf):
    """A lookup over the broadcast threshold, a dominant zone, unresolved and NULL locations."""
    zones = spark.range(50).select(
        F.col("id").cast("int").alias("location_id"),
        *[F.concat(F.lit(c), "id").alias(c) for c in ("borough", "zone", "service_zone")],
    )
    trips = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 60)
        .cast("int").alias("pickup_location_id"),
        (F.col("id") % 55).cast("int").alias("dropoff_location_id"),
    )
    small = add_both_zones(trips, zones)
    expected = sorted(map(str, small.collect()))
    assert len(expected) == 9000
    assert small.where("pickup_zone IS NULL").count() > 0
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    large = add_both_zones(trips, zones)
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, large.collect())) == expected


def _dense_ranks(values):
    distinct = sorted({v for v in values if v is not None}, reverse=True)
    return {v: distinct.index(v) + 1 if v is not None else len(distinct) + 1 for v in values}


def test_parallel_dense_rank(spark):
    values = [0.0, 0.5, 1.0, 1.0, 3.99, 4.0, -0.5, -7.0, -7.0, -1e9, 1e12, 1e12, 2.0**20, 2.0**20 - 0.01, None, None]
    values += [float(v * v % 997) for v in range(400)] + [5.0] * 200
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(5)
    expected = _dense_ranks(values)
    rows = dense_rank_desc(df, "v", "place").collect()
    assert sorted(row.id for row in rows) == list(range(len(values)))
    assert all(row.place == expected[row.v] for row in rows)


def test_parallel_dense_rank_of_one_value_and_of_nothing(spark):
    same = spark.range(10).withColumn("v", F.lit(3.0))
    assert {row.place for row in dense_rank_desc(same, "v", "place").collect()} == {1}
    assert dense_rank_desc(same.limit(0), "v", "place").collect() == []


def test_top_dense_rank_counts_rows_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1), ("e", 5)], "name string, n int")
    rows = top_dense_rank(df, "n", ["name"], 3, "place").collect()
    assert sorted((r.place, r.name) for r in rows) == [(1, "c"), (2, "a"), (2, "b")]


def test_spikes_match_brute_force(spark):
    demand = [(f"2024-01-{d:02d}", z, 200 if (d, z) == (9, "x") else d % 3 + len(z)) for d in range(1, 29) for z in "xyz"]
    demand += [(f"2024-01-{d:02d}", "flat", 4) for d in range(1, 29)]
    df = spark.createDataFrame(demand, "trip_date string, pickup_zone string, pickup_trip_count bigint")
    df = df.union(df.limit(0))
    history = defaultdict(list)
    for _, zone, n in demand:
        history[zone].append(n)
    expected = {
        (day, zone)
        for day, zone, n in demand
        if pstdev(history[zone]) and (n - fmean(history[zone])) / pstdev(history[zone]) > 2.5
    }
    assert expected == {("2024-01-09", "x")}
    assert {(r.trip_date, r.pickup_zone) for r in demand_spikes(df).collect()} == expected


def test_the_later_load_survives_whatever_its_name_or_amount(spark):
    row = "1 AS pickup_ts, 2 AS dropoff_ts, 3 AS pickup_location_id, 4 AS dropoff_location_id, 5D AS fare_amount, 6D AS trip_distance"
    rest = "1 AS payment_type, 1 AS rate_code_id, 1 AS vendor_id, 1 AS passenger_count"
    loads = [("run9", 1, 50.0), ("run10", 2, 40.0), ("run10", 3, 30.0)]
    frames = [
        spark.sql(f"SELECT {row}, '{batch}' AS batch_id, {amount}D AS total_amount, {rest}, timestamp_seconds({at}) AS ingestion_timestamp")
        for batch, at, amount in loads
    ]
    kept = dedup_trips(frames[0].union(frames[1]).union(frames[2])).collect()
    assert [(r.batch_id, r.total_amount) for r in kept] == [("run10", 30.0)]


def test_dense_rank_spreads_close_values_and_ranks_nan(spark):
    close = spark.range(5000).select((F.lit(1_000_000.0) + (F.col("id") % 2500) / 100).alias("x"))
    ranked = dense_rank_desc(close, "x", "r")
    assert ranked.agg(F.countDistinct("r"), F.min("r"), F.max("r")).first() == (2500, 1, 2500)
    assert ranked.where("r = 1").select("x").distinct().first().x == 1_000_024.99
    odd = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (2.0,), (1.0,)], "x double")
    assert [r.r for r in dense_rank_desc(odd, "x", "r").orderBy("r").collect()] == [1, 2, 3, 3, 4]
