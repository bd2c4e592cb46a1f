"""Scalar expressions over one trip."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(pickup: str = "pickup_ts", dropoff: str = "dropoff_ts") -> Column:
    """Minutes between two timestamps, each floored to its whole second first."""
    return (F.unix_seconds(dropoff) - F.unix_seconds(pickup)) / F.lit(60.0)


def positive(value: str) -> Column:
    """The value where it is above zero, else NULL: a divisor that cannot raise."""
    return F.when(F.col(value) > 0, F.col(value))


def speed_mph(distance: str = "trip_distance", minutes: str = "trip_duration_minutes") -> Column:
    """Miles per hour; NULL unless the duration is above zero."""
    return F.col(distance) / (positive(minutes) / F.lit(60.0))


def per_unit(amount: str, unit: str) -> Column:
    """Amount per unit; NULL unless the unit is above zero."""
    return F.col(amount) / positive(unit)


def month_key(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")
