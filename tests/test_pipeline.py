"""The incremental job: expected states, reruns, failures and parts against wholes."""

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from compare import SMALL
from kerbline import Lake, TripLimits, run_months, schemas
from kerbline.plans import gold, silver
from kerbline.plans.incremental import PUBLISHED, batches_holding, land_trips, session_zone
from kerbline.sources.monthly import conform
from kerbline.sources.tables import register_views
from workload import stage
from workload.queries import incremental_lake
from workload.relations import AIRPORTS, zones_raw

TWO_RUNS = [("1999-06", "1999-07"), ("1999-07", "1999-08")]


@pytest.fixture(scope="module")
def lake(spark):
    return incremental_lake(spark, SMALL, TWO_RUNS)


@pytest.fixture(scope="module")
def zone_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zones") / "csv")
    zones_raw(spark, SMALL).write.option("header", True).csv(path)
    return path


def _by_month(spark, lake):
    return {r.pickup_month: r["count"] for r in lake.read(spark, "silver_trips").groupBy("pickup_month").count().collect()}


def test_two_runs_end_in_the_expected_state(spark, lake):
    assert _by_month(spark, lake) == {"1999-06": 63, "1999-07": 47, "1999-08": 41}
    assert lake.read(spark, "demand_by_zone_hour_mart").count() == 120


def test_late_rows_of_a_finished_month_are_dropped(spark):
    # At this scale the August file holds four July pickups that pass every rule.
    larger = incremental_lake(spark, SMALL.replace("0.001", "0.01"), TWO_RUNS)
    assert _by_month(spark, larger) == {"1999-06": 554, "1999-07": 578, "1999-08": 677}
    assert larger.read(spark, "demand_by_zone_hour_mart").count() == 1406
    bronze = larger.read(spark, "yellow_trips").where("batch_id = 'run2'")
    assert bronze.where("tpep_pickup_datetime < timestamp_ntz'1999-08-01 00:00:00'").count() >= 4


def test_batches_and_months_are_recorded(spark, lake):
    batches = {r.batch_id for r in lake.read(spark, "yellow_trips").select("batch_id").distinct().collect()}
    assert batches == {"run1", "run2"}
    assert sorted(r.month for r in lake.read(spark, "months_done").collect()) == ["1999-06", "1999-07", "1999-08"]


def test_only_batches_holding_a_month_are_read(spark, lake):
    held = {(r.batch_id, r.month) for r in lake.read(spark, "batch_months").collect()}
    bronze = lake.read(spark, "yellow_trips")
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    assert held == set(map(tuple, bronze.select("batch_id", month).distinct().collect()))
    assert batches_holding(spark, lake, ["1999-06"]) == ["run1"]
    assert batches_holding(spark, lake, ["2031-01"]) == []


def test_mart_totals_agree_with_the_fact(spark, lake):
    tables = lake.published(spark)
    trips = tables["fact_taxi_trips"].count()
    assert trips == 63 + 47 + 41
    for mart, column in (
        ("demand_by_zone_hour_mart", "pickup_trip_count"),
        ("revenue_by_borough_day_mart", "trip_count"),
        ("payment_behavior_mart", "trip_count"),
    ):
        assert tables[mart].groupBy().sum(column).first()[0] == trips
    airport = gold.airport_trips(tables["fact_taxi_trips"], AIRPORTS).count()
    assert tables["airport_trip_mart"].groupBy().sum("trip_count").first()[0] == airport


def _rows(df, digits=9):
    def value(v):
        return round(v, digits) if isinstance(v, float) else v

    return sorted(str([value(row[c]) for c in sorted(df.columns)]) for row in df.collect())


def test_marts_built_in_parts_equal_marts_built_whole(spark, lake):
    tables = lake.published(spark)
    fact = tables["fact_taxi_trips"]
    assert _rows(tables["trip_efficiency_mart"]) == _rows(gold.efficiency_mart(gold.efficiency_parts(fact)))
    assert _rows(tables["revenue_by_borough_day_mart"]) == _rows(gold.revenue_mart(gold.payment_days(fact)))
    assert _rows(tables["payment_behavior_mart"]) == _rows(gold.payment_mart(gold.payment_days(fact)))


def test_published_tables_answer_sql_by_name(spark, lake):
    register_views(lake.published(spark))
    for name in PUBLISHED:
        assert spark.sql(f"SELECT count(*) AS n FROM {name}").first().n > 0


def _run(spark, lake, zone_csv, batch_id, start="1999-06", end="1999-06", **more):
    files = stage.month_files(spark, SMALL)
    return run_months(spark, lake, start, end, files, zone_csv, batch_id, airports=AIRPORTS, **more)


def test_finished_months_are_skipped_but_zones_refresh(spark, tmp_path, zone_csv):
    lake = Lake(f"{tmp_path}/lake")
    assert _run(spark, lake, zone_csv, "a").loaded == ["1999-06"]
    assert _run(spark, lake, zone_csv, "b").loaded == []
    assert [r.batch_id for r in lake.read(spark, "yellow_trips").select("batch_id").distinct().collect()] == ["a"]
    assert {r.batch_id for r in lake.read(spark, "taxi_zones").collect()} == {"b"}
    assert lake.read(spark, "dim_taxi_zones").count() == 24


def test_failed_run_is_repeated_without_doubling_trips(spark, tmp_path, zone_csv, monkeypatch):
    from kerbline.plans import incremental

    lake = Lake(f"{tmp_path}/lake")

    def fail(*_):
        raise ValueError("gate")

    monkeypatch.setattr(incremental, "require_valid", fail)
    with pytest.raises(ValueError, match="gate"):
        _run(spark, lake, zone_csv, "a")
    monkeypatch.undo()
    with pytest.raises(AnalysisException):
        lake.read(spark, "months_done")
    assert _run(spark, lake, zone_csv, "b").loaded == ["1999-06"]
    assert _by_month(spark, lake) == {"1999-06": 63}
    assert {r.batch_id for r in lake.read(spark, "silver_trips").collect()} == {"b"}


def test_slices_give_the_same_tables(spark, tmp_path, zone_csv):
    whole, sliced = Lake(f"{tmp_path}/whole"), Lake(f"{tmp_path}/sliced")
    for lake, size in ((whole, None), (sliced, 2)):
        loaded = _run(spark, lake, zone_csv, "a", "1999-05", "1999-09", months_per_pass=size).loaded
        assert loaded == ["1999-05", "1999-06", "1999-07", "1999-08", "1999-09"]
    for name in PUBLISHED:
        drop = ["ingestion_timestamp", "batch_id"]
        assert _rows(whole.read(spark, name).drop(*drop)) == _rows(sliced.read(spark, name).drop(*drop)), name
    assert sliced.read(spark, "months_done").count() == 5


def test_a_slice_opens_the_files_of_its_own_batches(spark, tmp_path, zone_csv):
    lake = Lake(f"{tmp_path}/sliced")
    _run(spark, lake, zone_csv, "a", "1999-05", "1999-09", months_per_pass=1)
    bronze = lake.read(spark, "yellow_trips")
    files = bronze.select("_metadata.file_path").distinct()
    assert {r.batch_id for r in bronze.select("batch_id").distinct().collect()} == {f"a-{n:04d}" for n in range(1, 6)}
    held = batches_holding(spark, lake, ["1999-06"])
    # June's file is the second; trips that end in July may stand in the third.
    assert "a-0002" in held and len(held) <= 2
    text = silver.silver_trips(bronze.where(F.col("batch_id").isin(held)), lake.read(spark, "silver_zones"), months=["1999-06"])
    opened = bronze.where(F.col("batch_id").isin(held)).select("_metadata.file_path").distinct().count()
    assert opened < files.count()
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id", text._jdf.queryExecution().executedPlan().toString())


def test_columns_unknown_to_the_contract_stay_in_bronze(spark, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    for batch_id, columns in (("b1", ["id AS VendorID"]), ("b2", ["id AS VendorID", "0.75D AS added_fee"])):
        trips = conform(spark.range(1).selectExpr(*columns), schemas.RAW_TRIP)
        land_trips(trips.withColumn("source_file", F.lit("file")), lake, "trips", batch_id)
    stored = lake.read(spark, "yellow_trips")
    assert sorted((r.batch_id, r.added_fee) for r in stored.collect()) == [("b1", None), ("b2", 0.75)]
    trips = conform(spark.range(1).selectExpr("id AS VendorID", "'x' AS added_fee"), schemas.RAW_TRIP)
    with pytest.raises(ValueError, match="added_fee was delivered as double"):
        land_trips(trips.withColumn("source_file", F.lit("file")), lake, "trips", "b3")


def test_a_run_repeated_with_rules_that_reject_all_leaves_nothing_behind(spark, tmp_path, zone_csv, monkeypatch):
    lake = Lake(f"{tmp_path}/lake")

    def fail(*args):
        raise RuntimeError("lost after silver")

    monkeypatch.setattr("kerbline.plans.incremental.publish_gold", fail)
    with pytest.raises(RuntimeError, match="lost after silver"):
        _run(spark, lake, zone_csv, "a")
    monkeypatch.undo()
    assert lake.read(spark, "silver_trips").count() > 0
    none = TripLimits(payment_types=(77,))
    assert _run(spark, lake, zone_csv, "b", limits=none).loaded == ["1999-06"]
    assert spark.read.parquet(lake.path("silver_trips")).count() == 0 if _has_files(lake, "silver_trips") else True


def _has_files(lake, table):
    from pathlib import Path

    return any(Path(lake.path(table)).rglob("*.parquet"))


def test_gathering_changes_no_table(spark, tmp_path, zone_csv):
    lakes = [Lake(f"{tmp_path}/{gather}") for gather in (True, False)]
    for lake, gather in zip(lakes, (True, False)):
        _run(spark, lake, zone_csv, "a", "1999-06", "1999-07", gather=gather)
    for table in ("silver_trips", "demand_by_zone_hour_mart", "payment_behavior_mart"):
        one, two = (lake.read(spark, table).drop("ingestion_timestamp") for lake in lakes)
        assert _rows(one) == _rows(two)


def test_gate_can_recheck_months_of_earlier_runs(spark, tmp_path, zone_csv):
    lake = Lake(f"{tmp_path}/lake")
    _run(spark, lake, zone_csv, "a")
    strict = TripLimits(payment_types=(1, 2))
    with pytest.raises(ValueError, match="payment_type_accepted"):
        _run(spark, lake, zone_csv, "b", "1999-07", "1999-07", limits=strict, recheck_all_months=True)
    assert _run(spark, lake, zone_csv, "c", "1999-07", "1999-07", limits=strict).loaded == ["1999-07"]


def test_session_zone_is_put_back(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    with pytest.raises(KeyError), session_zone(spark, "America/New_York"):
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        raise KeyError
    assert spark.conf.get("spark.sql.session.timeZone") == before
