import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.plans.bronze import stamp_load
from kerbline.plans.silver import typed_trips
from kerbline.sinks import append_batch, replace_months, replace_table
from kerbline.sources.monthly import conform, scan_months
from kerbline.sources.tables import load_table, only_months, register_views
from kerbline.sources.zones import scan_zone_csv


def _file(spark, path, columns):
    spark.range(2).select(*[F.expr(f"{value} AS {name}") for name, value in columns.items()]).write.parquet(path)
    return path


def test_monthly_scan_reconciles_types_spelling_and_missing_columns(spark, tmp_path):
    old = {"VendorID": "id", "passenger_count": "id", "tpep_pickup_datetime": "timestamp_ntz'2011-01-01 00:00:00'"}
    mid = {"VendorID": "cast(id as int)", "passenger_count": "cast(id as double)", "airport_fee": "1.25D"}
    new = {"VendorID": "cast(id as int)", "passenger_count": "id", "Airport_fee": "2", "added_fee": "0.75D"}
    paths = [_file(spark, f"{tmp_path}/{n}", c) for n, c in (("old", old), ("mid", mid), ("mid2", mid), ("new", new))]
    trips = scan_months(spark, paths)
    assert trips.columns == [*schemas.names(schemas.RAW_TRIP), "source_file", "added_fee"]
    assert dict(trips.dtypes)["VendorID"] == "bigint" and dict(trips.dtypes)["passenger_count"] == "double"
    assert trips.count() == 8
    folder = F.element_at(F.split("source_file", "/"), -2)
    fees = {(r.f, r.Airport_fee, r.added_fee) for r in trips.withColumn("f", folder).collect()}
    assert fees == {("old", None, None), ("mid", 1.25, None), ("mid2", 1.25, None), ("new", 2.0, 0.75)}


def test_months_that_only_add_columns_are_one_scan(spark, tmp_path):
    first = _file(spark, f"{tmp_path}/first", {"VendorID": "id"})
    second = _file(spark, f"{tmp_path}/second", {"VendorID": "id", "Airport_fee": "1.5D"})
    trips = scan_months(spark, [first, second])
    assert trips._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(r.Airport_fee or 0.0 for r in trips.collect()) == [0.0, 0.0, 1.5, 1.5]


def test_malformed_values_raise_or_become_null(spark):
    raw = spark.createDataFrame(
        [("2024-01-01 10:00:00", "5"), ("yesterday", "many")], "tpep_pickup_datetime string, PULocationID string"
    )
    with pytest.raises(PySparkException):
        conform(raw, schemas.RAW_TRIP).collect()
    lenient = conform(raw, schemas.RAW_TRIP, lenient=True)
    assert [r.PULocationID for r in lenient.collect()] == [5, None]
    stamped = stamp_load(raw.select(*[F.lit(None).alias(c) for c in schemas.names(schemas.RAW_TRIP)
                                      if c not in raw.columns], "*"), "trips", "b1", "here")
    with pytest.raises(PySparkException):
        typed_trips(stamped).collect()
    kept = [(str(r.pickup_ts), r.pickup_location_id) for r in typed_trips(stamped, lenient=True).collect()]
    assert kept == [("2024-01-01 10:00:00", 5), ("None", None)]


def test_zone_csv_blank_is_null_and_na_is_text(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,Unknown,N/A,\n')
    rows = sorted(map(tuple, scan_zone_csv(spark, str(path)).collect()))
    assert rows == [("1", "EWR", "Newark, Airport", "EWR"), ("264", "Unknown", "N/A", None)]


def test_append_is_the_union_of_its_batches(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    for batch_id in ("20240101000000", "20240201000000", "20240201000000"):
        append_batch(spark.range(3).withColumn("batch_id", F.lit(batch_id)), path)
    table = load_table(spark, path, "id bigint, batch_id string")
    assert sorted(map(tuple, table.groupBy("batch_id").count().collect())) == [
        ("20240101000000", 3),
        ("20240201000000", 6),
    ]


def _month_rows(spark, **months):
    return spark.createDataFrame([(v, k) for k, vs in months.items() for v in vs], "v int, m string")


def test_replace_months_leaves_other_months_and_the_session_alone(spark, tmp_path):
    path = f"{tmp_path}/silver"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    replace_months(_month_rows(spark, a=[1, 2], b=[3], c=[4]), path, "m")
    replace_months(_month_rows(spark, b=[30, 31]), path, "m", gather=False)
    table = load_table(spark, path, "v int, m string")
    assert sorted(map(tuple, table.collect())) == [(1, "a"), (2, "a"), (4, "c"), (30, "b"), (31, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert [r.v for r in only_months(table, ["c"], "m").collect()] == [4]


def test_named_months_without_rows_are_emptied(spark, tmp_path):
    path = f"{tmp_path}/silver"
    replace_months(_month_rows(spark, a=[1], b=[2], c=[3]), path, "m")
    replace_months(_month_rows(spark, b=[20]), path, "m", months=["a", "b", "d"])
    table = load_table(spark, path, "v int, m string")
    assert sorted(map(tuple, table.collect())) == [(3, "c"), (20, "b")]


def test_replace_table_replaces_everything_even_in_dynamic_sessions(spark, tmp_path):
    path = f"{tmp_path}/zones"
    replace_table(spark.range(5), path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        replace_table(spark.range(2), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert load_table(spark, path, "id bigint").count() == 2


def test_a_dominant_month_is_written_by_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/skewed"
    month = F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 40).cast("string"))
    rows = spark.range(0, 200_000, 1, 16).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), month.alias("m"))
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        replace_months(rows, path, "m")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = load_table(spark, path, "v string, m string").select("m", "_metadata.file_path").distinct()
    per_month = {r.m: r["count"] for r in files.groupBy("m").count().collect()}
    # Thin months that hash next to the dominant one are cut along with it; the others stay whole.
    thin = sorted(n for m, n in per_month.items() if m != "hot")
    assert per_month["hot"] > 4 and len(thin) == 40 and thin[len(thin) // 2] == 1


def test_views_give_tables_their_bare_names(spark):
    register_views({"some_mart": spark.range(4)})
    assert spark.sql("SELECT sum(id) AS s FROM some_mart").first().s == 6
