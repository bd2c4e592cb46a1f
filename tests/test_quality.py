import pytest
from pyspark.sql import Row

from kerbline import TripLimits
from kerbline.operators.quality import check_trips, keep_valid, quarantine, require_valid, trip_rules

SCHEMA = (
    "pickup_location_id int, dropoff_location_id int, payment_type int, rate_code_id int, pickup_ts string, "
    "dropoff_ts string, fare_amount double, trip_distance double, pickup_zone string, dropoff_zone string, "
    "trip_duration_minutes double, trip_speed_mph double"
)
GOOD = {
    "pickup_location_id": 1,
    "dropoff_location_id": 2,
    "payment_type": 1,
    "rate_code_id": 1,
    "pickup_ts": "2024-01-01 10:00:00",
    "dropoff_ts": "2024-01-01 10:30:00",
    "fare_amount": 10.0,
    "trip_distance": 5.0,
    "pickup_zone": "Midtown",
    "dropoff_zone": "SoHo",
    "trip_duration_minutes": 30.0,
    "trip_speed_mph": 10.0,
}
NARROW = TripLimits(payment_types=(1, 2), rate_codes=(1, 2))


def _rows(spark, *changes):
    return spark.createDataFrame([Row(**{**GOOD, **change}) for change in changes], SCHEMA)


def _failed(df, limits=NARROW):
    return {row.check_name: row.failed_rows for row in check_trips(df, limits).collect() if not row.passed}


def test_all_bad_row_fails_five_checks(spark):
    bad = {
        "pickup_location_id": None,
        "dropoff_ts": "2024-01-01 09:00:00",
        "fare_amount": -1.0,
        "trip_distance": -2.0,
        "pickup_zone": None,
        "trip_duration_minutes": -5.0,
        "trip_speed_mph": 120.0,
    }
    assert _failed(_rows(spark, bad)) == {
        "null_key_identifiers": 1,
        "timestamps_valid": 1,
        "non_negative_fare_distance": 1,
        "zone_integrity": 1,
        "duration_speed_anomaly": 1,
    }


def test_suite_lists_seven_checks_in_order(spark):
    rows = check_trips(_rows(spark, {})).collect()
    assert [row.check_name for row in rows] == list(trip_rules())
    assert len(rows) == 7 and all(row.passed and row.failed_rows == 0 for row in rows)
    assert all(row.passed for row in check_trips(_rows(spark, {}).limit(0)).collect())


def test_filter_keeps_one_of_three(spark):
    reversed_time = {"pickup_ts": "2024-01-01 12:00:00", "dropoff_ts": "2024-01-01 11:00:00"}
    df = _rows(spark, {}, {"payment_type": 0}, {**reversed_time, "trip_duration_minutes": -60.0})
    assert keep_valid(df, NARROW).count() == 1


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"trip_duration_minutes": 480.0}, True),
        ({"trip_duration_minutes": 480.01}, False),
        ({"trip_duration_minutes": 0.0}, False),
        ({"trip_speed_mph": 80.0}, True),
        ({"trip_speed_mph": 80.01}, False),
        ({"fare_amount": 0.0}, True),
        ({"fare_amount": -0.01}, False),
        ({"trip_distance": 0.0}, True),
        ({"trip_distance": -0.01}, False),
        ({"dropoff_ts": GOOD["pickup_ts"]}, False),
        ({"payment_type": 6}, True),
        ({"payment_type": 7}, False),
        ({"rate_code_id": 99}, True),
        ({"rate_code_id": 98}, False),
    ],
)
def test_boundaries_are_inclusive(spark, change, kept):
    df = _rows(spark, change)
    assert (keep_valid(df).count() == 1) is kept
    assert (_failed(df, TripLimits()) == {}) is kept


@pytest.mark.parametrize("column", SCHEMA.replace(",", "").split()[::2])
def test_null_is_dropped_but_only_keys_and_zones_are_counted(spark, column):
    df = _rows(spark, {column: None})
    counted = {
        "pickup_location_id": "null_key_identifiers",
        "dropoff_location_id": "null_key_identifiers",
        "pickup_zone": "zone_integrity",
        "dropoff_zone": "zone_integrity",
    }
    assert keep_valid(df).count() == 0
    assert list(_failed(df, TripLimits())) == ([counted[column]] if column in counted else [])
    assert quarantine(df).count() == 1


def test_kept_and_quarantined_make_up_the_input(spark):
    df = _rows(spark, {}, {"payment_type": None}, {"fare_amount": -1.0, "rate_code_id": 7}, {"pickup_zone": None})
    rejected = quarantine(df)
    labels = sorted(tuple(row.rejected_by) for row in rejected.collect())
    assert labels == [
        ("payment_type_accepted",),
        ("rate_code_accepted", "non_negative_fare_distance"),
        ("zone_integrity",),
    ]
    together = keep_valid(df).union(rejected.drop("rejected_by"))
    assert sorted(map(str, together.collect())) == sorted(map(str, df.collect()))


def test_gate(spark):
    require_valid(_rows(spark, {}))
    with pytest.raises(ValueError, match="rate_code_accepted.*zone_integrity"):
        require_valid(_rows(spark, {"rate_code_id": 7}, {"pickup_zone": None}))
