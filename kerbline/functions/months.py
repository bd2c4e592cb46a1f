"""Calendar months: ranges, filters that reach the scan, and the work list."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from kerbline.functions.trips import month_key


def _first_day(month: Column) -> Column:
    return F.to_date(F.concat(month, F.lit("-01")))


def months_between(start: str, end: str) -> Column:
    """Array of 'yyyy-MM' from start to end, both included; NULL when start > end.

    `sequence` raises on reversed bounds, hence the guard.
    """
    first, last = _first_day(F.col(start)), _first_day(F.col(end))
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return F.transform(days, lambda day: F.date_format(day, "yyyy-MM"))


def explode_months(bounds: DataFrame, start: str = "start_month", end: str = "end_month") -> DataFrame:
    """One row per month of each row's range; a reversed range gives no rows."""
    keep = [c for c in bounds.columns if c not in (start, end)]
    ranged = bounds.select(*keep, months_between(start, end).alias("months"))
    return ranged.select(*keep, F.explode("months").alias("month"))


def months_todo(requested: DataFrame, done: DataFrame) -> DataFrame:
    """Requested months that no earlier run has finished."""
    return requested.select("month").distinct().join(done.select("month"), "month", "left_anti")


def months_after(done: DataFrame, finished: DataFrame) -> DataFrame:
    """The set of finished months once this run's are added."""
    return done.select("month").union(finished.select("month")).distinct()


def _next_month(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def _spans(months: list[str]) -> list[tuple[date, date]]:
    """Half-open day spans covering the months, neighbours merged."""
    spans: list[tuple[date, date]] = []
    for first in sorted({date.fromisoformat(f"{m}-01") for m in months}):
        if spans and spans[-1][1] == first:
            spans[-1] = (spans[-1][0], _next_month(first))
        else:
            spans.append((first, _next_month(first)))
    return spans


def in_months(df: DataFrame, ts: str, months: list[str] | None) -> DataFrame:
    """Rows whose timestamp falls in one of the months; no months means all rows.

    Written as half-open ranges on the stored column rather than on its
    formatted month, so both bounds reach the Parquet scan and skip row groups.
    Text timestamps cannot be compared that way and fall back to the month key.
    """
    if not months:
        return df
    kind = df.schema[ts].dataType
    if not isinstance(kind, (TimestampType, TimestampNTZType)):
        return df.where(month_key(ts).isin(sorted(set(months))))
    stored = kind.simpleString()
    matches = None
    for first, after in _spans(months):
        low, high = (F.lit(f"{day} 00:00:00").cast(stored) for day in (first, after))
        span = (F.col(ts) >= low) & (F.col(ts) < high)
        matches = span if matches is None else matches | span
    return df.where(matches)
