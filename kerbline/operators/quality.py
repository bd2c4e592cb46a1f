"""Trip quality: one list of rules read as row filter, check suite and gate.

Each rule states both sides on purpose. A filter keeps a row only when its test
is true, a check counts a row only when its opposite is true, and a NULL is
neither: a NULL payment type is dropped by the filter and not counted by the
check.
"""

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TripLimits:
    """Thresholds; the defaults are fixed values of the published data contract."""

    payment_types: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    rate_codes: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 99)
    max_hours: float = 8
    max_mph: float = 80


@dataclass(frozen=True)
class Rule:
    name: str
    keep: Column
    fails: Column


def trip_rules(limits: TripLimits = TripLimits()) -> dict[str, Rule]:
    """The seven rules in the order they are reported."""
    c = F.col
    longest = float(limits.max_hours * 60)
    fastest = float(limits.max_mph)
    paid = c("payment_type").isin(*limits.payment_types)
    rated = c("rate_code_id").isin(*limits.rate_codes)
    minutes, mph = c("trip_duration_minutes"), c("trip_speed_mph")
    rules = [
        Rule(
            "null_key_identifiers",
            keep=c("pickup_location_id").isNotNull() & c("dropoff_location_id").isNotNull(),
            fails=c("pickup_location_id").isNull() | c("dropoff_location_id").isNull(),
        ),
        Rule("payment_type_accepted", keep=paid, fails=~paid),
        Rule("rate_code_accepted", keep=rated, fails=~rated),
        Rule(
            "timestamps_valid",
            keep=c("pickup_ts") < c("dropoff_ts"),
            fails=c("pickup_ts") >= c("dropoff_ts"),
        ),
        Rule(
            "non_negative_fare_distance",
            keep=(c("fare_amount") >= 0) & (c("trip_distance") >= 0),
            fails=(c("fare_amount") < 0) | (c("trip_distance") < 0),
        ),
        Rule(
            "zone_integrity",
            keep=c("pickup_zone").isNotNull() & c("dropoff_zone").isNotNull(),
            fails=c("pickup_zone").isNull() | c("dropoff_zone").isNull(),
        ),
        Rule(
            "duration_speed_anomaly",
            keep=(minutes > 0) & (minutes <= longest) & (mph <= fastest),
            fails=(minutes <= 0) | (minutes > longest) | (mph > fastest),
        ),
    ]
    return {rule.name: rule for rule in rules}


def keep_valid(trips: DataFrame, limits: TripLimits = TripLimits(), only: tuple[str, ...] = ()) -> DataFrame:
    """Rows that every rule keeps (or every rule named in `only`)."""
    rules = trip_rules(limits)
    for name in only or rules:
        trips = trips.where(rules[name].keep)
    return trips


def check_trips(trips: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """One row per rule: check_name, failed_rows, passed. A single pass for all seven."""
    rules = trip_rules(limits)
    counts = trips.agg(*[F.count_if(rule.fails).alias(name) for name, rule in rules.items()])
    rows = counts.unpivot([], list(rules), "check_name", "failed_rows")
    return rows.withColumn("passed", F.col("failed_rows") == 0)


def require_valid(trips: DataFrame, limits: TripLimits = TripLimits()) -> None:
    """Log every check and raise if one failed. Seven rows reach the driver."""
    results = check_trips(trips, limits).collect()
    for row in results:
        log.info("check %s passed=%s failed_rows=%d", row.check_name, row.passed, row.failed_rows)
    failed = [row.check_name for row in results if not row.passed]
    if failed:
        raise ValueError(f"trip quality checks failed: {failed}")


def quarantine(trips: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """The rows `keep_valid` rejects, each with the names of the rules that rejected it."""
    labels = [
        F.when(~F.coalesce(rule.keep, F.lit(False)), F.lit(name)) for name, rule in trip_rules(limits).items()
    ]
    labelled = trips.withColumn("rejected_by", F.array_compact(F.array(*labels)))
    return labelled.where(F.size("rejected_by") > 0)
