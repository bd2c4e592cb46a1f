from pyspark.sql import Row
from pyspark.sql import functions as F

from kerbline.functions import trips as tf
from kerbline.functions.money import money_avg, money_sum
from kerbline.functions.months import explode_months, in_months, months_after, months_todo
from kerbline.plans.silver import add_duration_speed


def _times(spark, pickup, dropoff, distance):
    df = spark.createDataFrame([Row(pickup_ts=pickup, dropoff_ts=dropoff, trip_distance=distance)])
    return df.withColumns({c: F.to_timestamp(c) for c in ("pickup_ts", "dropoff_ts")})


def test_duration_and_speed(spark):
    row = add_duration_speed(_times(spark, "2024-01-01 10:00:00", "2024-01-01 10:30:00", 10.0)).first()
    assert (row.trip_duration_minutes, row.trip_speed_mph) == (30.0, 20.0)


def test_duration_floors_each_end(spark):
    row = add_duration_speed(_times(spark, "2024-01-01 10:00:00.9", "2024-01-01 10:00:01.1", 1.0)).first()
    assert row.trip_duration_minutes == 1 / 60.0


def test_speed_needs_a_positive_duration(spark):
    for dropoff in ("2024-01-01 10:00:00", "2024-01-01 09:00:00"):
        row = add_duration_speed(_times(spark, "2024-01-01 10:00:00", dropoff, 5.0)).first()
        assert row.trip_speed_mph is None


def test_per_unit_guards_zero(spark):
    df = spark.createDataFrame([(6.0, 2.0), (6.0, 0.0), (6.0, -1.0)], "fare double, miles double")
    assert [r[0] for r in df.select(tf.per_unit("fare", "miles")).collect()] == [3.0, None, None]


def _months(spark, start, end):
    bounds = spark.createDataFrame([(start, end)], "start_month string, end_month string")
    return [row.month for row in explode_months(bounds).collect()]


def test_month_range(spark):
    assert _months(spark, "2024-01", "2024-03") == ["2024-01", "2024-02", "2024-03"]
    assert _months(spark, "2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert _months(spark, "2024-05", "2024-05") == ["2024-05"]
    assert _months(spark, "2024-03", "2024-01") == []


def test_month_sets(spark):
    requested = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-02",)], "month string")
    done = spark.createDataFrame([("2024-01",), ("2023-12",)], "month string")
    todo = months_todo(requested, done)
    assert [r.month for r in todo.collect()] == ["2024-02"]
    assert sorted(r.month for r in months_after(done, todo).collect()) == ["2023-12", "2024-01", "2024-02"]


def test_in_months_equals_formatted_filter(spark):
    days = spark.sql(
        "SELECT explode(sequence(timestamp_ntz'2023-10-31 23:59:59', timestamp_ntz'2024-03-02 00:00:00',"
        " interval 1 hour)) AS ts"
    ).union(spark.sql("SELECT CAST(NULL AS timestamp_ntz)"))
    wanted = ["2023-12", "2024-01", "2024-03"]
    expected = sorted(days.where(F.date_format("ts", "yyyy-MM").isin(wanted)).collect())
    assert sorted(in_months(days, "ts", wanted).collect()) == expected
    assert in_months(days, "ts", None) is days
    as_text = days.select(F.col("ts").cast("string").alias("ts"))
    assert in_months(as_text, "ts", wanted).count() == len(expected)


def test_money_is_exact_in_any_order(spark):
    amounts = spark.range(30000).select((F.col("id") % 100 / 100.0 + 0.1).alias("x"), (F.col("id") % 7).alias("k"))
    total = amounts.agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first()
    assert total.s == 17850.0 and total.a == 0.595
    shuffled = amounts.repartition(7, "k").agg(money_sum("x").alias("s")).first()
    assert shuffled.s == total.s
    nothing = amounts.where("x < 0").agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first()
    assert nothing.s is None and nothing.a is None


def test_money_loses_nothing_and_stops_nothing(spark):
    def both(values):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        row = frame.agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first()
        return row.s, row.a

    assert both([0.004] * 1000) == (4.0, 0.004)
    assert both([1e20, 1.0]) == (1e20 + 1.0, (1e20 + 1.0) / 2)
    assert both([float("inf"), 1.0, None])[0] == float("inf")
    assert both([float("nan"), 1.0])[0] != both([float("nan"), 1.0])[0]
