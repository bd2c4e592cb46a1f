"""What the physical plans must and must not contain."""

import re

from compare import SMALL
from pyspark.sql import functions as F

from kerbline import TripLimits
from kerbline.functions.months import in_months
from kerbline.plans import gold, reports, silver
from kerbline.sources.tables import TASK_LIMITS, bounded_tasks, only_months
from workload import relations, stage
from workload.queries import all_queries
from workload.relations import AIRPORTS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_columns(df):
    return set(re.findall(r"(\w+)#", re.search(r"FileScan parquet \[([^\]]*)\]", plan(df))[1]))


def test_month_filter_reaches_the_scan(spark):
    trips = in_months(stage.table(spark, SMALL, "yellow_trips"), "tpep_pickup_datetime", ["1999-06", "1999-07"])
    pushed = re.search(r"PushedFilters: \[.*", plan(trips))[0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "LessThan(tpep_pickup_datetime" in pushed


def test_partition_filter_prunes_months(spark):
    trips = only_months(stage.table(spark, SMALL, "silver_trips"), ["1999-06"], "pickup_month")
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_month", plan(trips))
    files = trips.select("_metadata.file_path").distinct().collect()
    assert all("pickup_month=1999-06" in row.file_path for row in files)


def _silver(spark):
    bronze, zones = (stage.table(spark, SMALL, name) for name in ("yellow_trips", "silver_zones"))
    return silver.silver_trips(bronze, zones, TripLimits())


def test_silver_shuffles_once_and_cuts_copies_before_it(spark):
    text = plan(_silver(spark))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastHashJoin") == 2
    after, before = text.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in after and "WindowGroupLimit" in before


def test_rules_on_the_dedup_key_run_before_the_shuffle_and_others_after(spark):
    above, below = plan(_silver(spark)).split("Exchange hashpartitioning")
    kept_above = re.search(r"Filter \(\(\(?_copy.*", above)[0]
    assert "payment_type" in kept_above and "rate_code_id" in kept_above
    assert "trip_distance" not in kept_above
    scan_filter = re.search(r"Filter .*isnotnull\(tpep_pickup_datetime.*", below)[0]
    assert "fare_amount" in scan_filter and "unix_seconds" in scan_filter
    assert "payment_type" not in scan_filter


def test_marts_read_only_their_columns(spark):
    fact = stage.table(spark, SMALL, "fact_taxi_trips")
    assert scan_columns(gold.airport_mart(fact, AIRPORTS)) == {
        "total_amount", "pickup_zone", "dropoff_zone", "trip_month",
    }
    text = plan(gold.airport_mart(fact, AIRPORTS))
    assert re.search(r"PushedFilters: \[Or\(In\(pickup_zone", text)
    assert "partial_sum" in text and "partial_count" in text


def test_top_k_never_sorts_everything(spark):
    demand = stage.table(spark, SMALL, "demand_by_zone_hour_mart")
    for report in (reports.peak_zone_hours, reports.top_zones, reports.top_zone_hours, reports.zone_ranking):
        text = plan(report(demand))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_no_cross_join_and_no_python_in_any_plan(spark):
    for name, query in all_queries().items():
        if name == "pipeline_incremental":
            continue
        text = plan(query(spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "Pandas" not in text, name


def test_trips_are_gathered_by_month_before_they_get_their_zones(spark):
    bronze, zones = (stage.table(spark, SMALL, name) for name in ("yellow_trips", "silver_zones"))
    text = plan(silver.silver_trips(bronze, zones, TripLimits(), gather=True))
    above, below = text.split("REBALANCE_PARTITIONS_BY_COL")
    assert above.count("BroadcastHashJoin") == 2 and "BroadcastHashJoin" not in below
    assert "payment_type" in re.search(r"Filter \(\(?\(?_copy.*", below)[0]
    gathered, plain = (silver.silver_trips(bronze, zones, TripLimits(), gather=gather) for gather in (True, False))
    assert gathered.exceptAll(plain).isEmpty() and plain.exceptAll(gathered).isEmpty()


def test_both_batches_of_bronze_come_from_one_pass(spark):
    raw = relations.raw_trips(spark, SMALL)
    both = relations.bronze_batches(raw)
    assert plan(both).count("lineitem.parquet") == 1
    for batch in ("b1", "b2"):
        one, want = both.where(F.col("batch_id") == batch).drop("batch_id"), relations.bronze_batch(raw, batch)
        assert one.exceptAll(want).isEmpty() and want.exceptAll(one).isEmpty()


def test_a_line_item_travels_for_its_order_only(spark):
    """Orders meet their customers first: with no table small enough to broadcast, line items are shuffled for their order and
    their supplier, not for the customer as well."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        raw = relations.raw_trips(spark, SMALL)
        text = plan(raw)
    finally:
        spark.conf.set(limit, before)
    assert text.count("Exchange hashpartitioning(o_custkey") == 1
    carried = text[text.index("Exchange hashpartitioning(o_custkey") :].split("Exchange")[1]
    assert "l_quantity" not in carried and "orders.parquet" in carried


def test_the_months_delivered_are_read_from_their_folders(spark, monkeypatch):
    root = stage.month_files(spark, SMALL)
    monkeypatch.setattr(stage, "bronze_lake", None)
    months = stage.month_list(spark, SMALL)
    assert months == sorted(months) and all(spark.read.parquet(root.format(month=month)).limit(1).count() == 1 for month in months[:2])


def test_tasks_take_bounded_parts_of_files_and_shuffles(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with bounded_tasks(spark):
        assert all(spark.conf.get(key) == limit for key, limit in TASK_LIMITS.items())
    assert spark.conf.get(name) == before
    spark.conf.set(name, "1MB")
    try:
        with bounded_tasks(spark):
            assert spark.conf.get(name) == "1MB"
    finally:
        spark.conf.set(name, before)
