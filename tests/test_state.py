"""Sketches, streams, spells, subqueries, buckets and corrections: boundaries, restarts and plans."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from kerbline.operators import sketches, spells
from kerbline.operators.upsert import corrected, upsert_months
from kerbline.schemas import RAW_TRIP
from kerbline.sinks import replace_months
from kerbline.sinks.bucketed import write_bucketed
from kerbline.sources.tables import load_table
from kerbline.streaming import hourly
from workload import analysis

START = datetime(2024, 1, 31, 22)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- sketches -------------------------------------------------------------


def test_merged_sketches_stay_within_their_bounds(spark):
    rows = spark.range(120_000).select((F.col("id") % 6).alias("m"), (F.col("id") % 30_000).alias("a"), (F.col("id") % 1000 / 10.0).alias("x"))
    months = sketches.month_sketches(rows, ["m"], ["a"], "x")
    halves = sketches.merged(months, [F.col("m") < 3])
    both = sketches.estimates(sketches.merged(halves, []), [0.1, 0.5, 0.9]).first()
    assert both.row_count == 120_000
    assert abs(both.distinct_estimate - 30_000) < 4 * 1.04 / 64 * 30_000
    assert all(abs(found / 100 - rank) < 0.033 for found, rank in zip(both.quantiles, (0.1, 0.5, 0.9)))


def test_sketches_of_missing_values(spark):
    rows = spark.createDataFrame([(1, None, 2.0), (1, 5, float("nan")), (2, None, None), (2, 6, 1.0)], "m int, a int, x double")
    one, two = sketches.estimates(sketches.month_sketches(rows, ["m"], ["a"], "x"), [0.5]).orderBy("m").collect()
    assert (one.row_count, one.distinct_estimate, one.quantiles) == (2, 1, [2.0])
    assert (two.row_count, two.distinct_estimate, two.quantiles) == (2, 1, [1.0])
    assert sketches.month_sketches(rows.where("false"), ["m"], ["a"], "x").count() == 0


# -- streams --------------------------------------------------------------


def _deliver(spark, folder, name, minutes):
    """A file of trips from zone 1, at minutes after the start."""
    values = [(START + timedelta(minutes=m),) for m in minutes]
    filled = spark.createDataFrame(values, "t timestamp_ntz")
    columns = [c.split() for c in RAW_TRIP.split(", ")]
    known = {"tpep_pickup_datetime": F.col("t"), "PULocationID": F.lit(1), "passenger_count": F.lit(2.0)}
    filled.select(*[known.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in columns]).coalesce(1).write.parquet(f"{folder}/{name}")


def _hours(spark, path):
    return {int((r.hour_start - START).total_seconds() // 3600): (r.trips, r.passengers, r.hour_month) for r in load_table(spark, path, hourly.HOURLY).collect()}


def test_runs_go_on_where_they_were_and_late_trips_follow_the_rule(spark, tmp_path):
    folder, path, checkpoint = (f"{tmp_path}/{name}" for name in ("files", "hours", "checkpoint"))

    def run():
        return hourly.run_available(spark, folder, path, checkpoint, "1 hour")

    _deliver(spark, folder, "a", [0, 10, 61, 130])
    run()
    assert _hours(spark, path) == {0: (2, 4, "2024-01"), 1: (1, 2, "2024-01"), 2: (1, 2, "2024-02")}
    # A run without new files changes nothing.
    run()
    assert _hours(spark, path)[0] == (2, 4, "2024-01")
    # The watermark stands at minute 70: hour 0 is closed, hour 1 is not.
    _deliver(spark, folder, "b", [5, 119, 300])
    ended = run()
    assert _hours(spark, path) == {0: (2, 4, "2024-01"), 1: (2, 4, "2024-01"), 2: (1, 2, "2024-02"), 5: (1, 2, "2024-02")}
    dropped = sum(int(s["numRowsDroppedByWatermark"]) for p in ended.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/hours"
    rows = spark.createDataFrame([(1, START, 3, 4), (2, START + timedelta(hours=3), 1, 1)], "pickup_location_id int, hour_start timestamp, trips bigint, passengers bigint")
    for _ in range(2):
        hourly.put_hours(rows, path)
        assert load_table(spark, path, hourly.HOURLY).count() == 2
    hourly.put_hours(rows.where("false"), path)
    hourly.put_hours(rows.limit(1).withColumn("trips", F.lit(9).cast("bigint")), path)
    assert sorted(r.trips for r in load_table(spark, path, hourly.HOURLY).collect()) == [1, 9]


# -- spells ---------------------------------------------------------------


def _times(spark, rows):
    return spark.createDataFrame([(z, None if s is None else START + timedelta(seconds=s)) for z, s in rows], "zone string, at timestamp").withColumn("n", F.lit(1))


def test_a_gap_longer_than_the_limit_ends_a_spell(spark):
    rows = _times(spark, [("a", 0), ("a", 599), ("a", 1198), ("a", 1798), ("a", 2399), ("b", 5), (None, 7), (None, 8), ("a", None)])
    for found in (
        spells.busy_spells(rows, ["zone"], "at", "600 seconds", [F.sum("n").alias("n")]),
        spells.spells_of_instants(rows, ["zone"], "at", 600, "n"),
    ):
        spans = sorted(((r.zone or "", int((r.begins - START).total_seconds()), int((r.ends - START).total_seconds()), r.n) for r in found.collect()))
        assert spans == [("", 7, 608, 2), ("a", 0, 2398, 4), ("a", 2399, 2999, 1), ("b", 5, 605, 1)]


def test_spells_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    rows = _times(spark, [("a", s) for s in (0, 100, 3000, 3100, 3100, 9000)] + [("b", 50)])
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withWatermark("at", "1 day")
    counted = spells.busy_spells(stream, ["zone"], "at", "10 minutes", [F.sum("n").alias("n")])
    seen = []
    writer = counted.writeStream.outputMode("complete").foreachBatch(lambda frame, _: seen.append(sorted(map(str, frame.collect()))))
    writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert seen[-1] == sorted(map(str, spells.busy_spells(rows, ["zone"], "at", "10 minutes", [F.sum("n").alias("n")]).collect()))


# -- subqueries and buckets -----------------------------------------------


@pytest.mark.parametrize("name", ["zones_above_borough_mean", "zones_with_airport_route", "days_without_card_payment", "days_above_week_before"])
def test_subqueries_become_equi_joins(spark, name):
    text = plan(analysis.all_queries()[name](spark, SMALL))
    assert "Subquery" not in text and "NestedLoop" not in text and "Cartesian" not in text and "Join" in text


def test_exists_and_not_exists_keep_rows_once(spark):
    for name, kind in (("zones_with_airport_route", "LeftSemi"), ("days_without_card_payment", "LeftAnti")):
        assert kind in plan(analysis.all_queries()[name](spark, SMALL))


def test_tables_bucketed_alike_join_and_group_without_a_shuffle(spark):
    query = analysis.all_queries()["bucketed_zone_shares"](spark, SMALL)
    text = plan(query)
    assert "Exchange" not in text and "SortMergeJoin" in text and text.count("Bucketed: true") == 2


def test_a_bucket_is_one_file(spark, tmp_path):
    table = write_bucketed(spark.range(1000).withColumn("k", F.col("id") % 50), "some_buckets", f"{tmp_path}/t", "k", 4)
    assert table.count() == 1000 and len(table.inputFiles()) == 4


def test_a_bucket_too_big_for_one_task_is_written_by_several(spark, tmp_path):
    rows = spark.range(400_000).select((F.col("id") % 2).alias("k"), F.xxhash64("id").alias("v"))
    limit = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "64k")
    try:
        table = write_bucketed(rows.repartition(16), "cut_buckets", f"{tmp_path}/t", "k", 2)
    finally:
        spark.conf.set(limit, before)
    assert len(table.inputFiles()) > 2
    assert sorted(table.groupBy("k").count().collect()) == [(0, 200_000), (1, 200_000)]
    assert "Exchange" not in plan(table.groupBy("k").count())


# -- corrections ----------------------------------------------------------

CONTRACT = "k int, day date, v int, m string"


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "k int, d string, v int, gone boolean, nth int").select("k", F.to_date("d").alias("day"), "v", "gone", "nth")


def _stored(spark, path):
    return sorted(((r.k, r.day.isoformat(), r.v) for r in load_table(spark, path, CONTRACT).collect()), key=str)


def test_only_months_with_a_corrected_key_are_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = _rows(spark, (1, "2024-01-05", 1, None, 0), (2, "2024-01-06", 2, None, 0), (None, "2024-02-01", 3, None, 0), (4, "2024-03-01", 4, None, 0))
    replace_months(base.select("k", "day", "v", F.date_format("day", "yyyy-MM").alias("m")), path, "m")
    files = {r[0] for r in load_table(spark, path, CONTRACT).select("_metadata.file_path").distinct().collect()}
    changes = _rows(
        spark, (1, "2024-01-05", 10, False, 1), (1, "2024-01-05", 11, False, 2), (None, "2024-02-01", 0, True, 1), (9, "2024-05-01", 9, None, 1), (8, "2024-05-02", 8, True, 1)
    )
    written = upsert_months(changes, path, CONTRACT, ["k", "day"], [F.desc("nth")], "m", "day", "gone")
    assert written == ["2024-01", "2024-02", "2024-05"]
    assert _stored(spark, path) == [(1, "2024-01-05", 11), (2, "2024-01-06", 2), (4, "2024-03-01", 4), (9, "2024-05-01", 9)]
    after = {r[0] for r in load_table(spark, path, CONTRACT).select("_metadata.file_path").distinct().collect()}
    assert {f for f in files if "m=2024-03" in f} == {f for f in after if "m=2024-03" in f}
    assert not {f for f in files if "m=2024-01" in f} & after
    # The same corrections again change nothing, and none writes nothing.
    upsert_months(changes, path, CONTRACT, ["k", "day"], [F.desc("nth")], "m", "day", "gone")
    assert len(_stored(spark, path)) == 4
    assert upsert_months(changes.where("false"), path, CONTRACT, ["k", "day"], [F.desc("nth")], "m", "day", "gone") == []


def test_corrections_read_only_their_months(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = _rows(spark, (1, "2024-01-05", 1, None, 0), (4, "2024-03-01", 4, None, 0)).select("k", "day", "v", F.date_format("day", "yyyy-MM").alias("m"))
    replace_months(base, path, "m")
    table = load_table(spark, path, CONTRACT).where(F.col("m").isin("2024-01"))
    text = plan(corrected(table, base.limit(1), ["k", "day"], [F.desc("v")]))
    assert "PartitionFilters: [isnotnull(m" in text or "PartitionFilters: [m" in text
