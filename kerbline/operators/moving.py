"""Moving and running measures over calendar days.

A key's rows are its days, a bounded number however many trips it has: a hot
zone is shrunk to a row per day before the window sees it. All frames of one
call share partitioning and order, so there is one shuffle and one sort.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.money import MONEY


def calendar_days(days: DataFrame, keys: list[str], measures: list[str], day: str = "trip_date") -> DataFrame:
    """Every day from a key's first to its last; a day without a row has zeros.

    Takes one row per key and day. Each row is repeated up to the day before the
    key's next row, so no calendar has to be joined. Rows without a day are left out.
    """
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    until = F.coalesce(F.date_sub("_next", 1), F.col(day))
    known = days.where(F.col(day).isNotNull()).withColumn("_next", following)
    spread = known.withColumn("_day", F.explode(F.sequence(F.col(day), until)))
    filled = {name: F.when(F.col("_day") == F.col(day), F.col(name)).otherwise(F.lit(0)).cast(days.schema[name].dataType) for name in measures}
    return spread.withColumns(filled).withColumn(day, F.col("_day")).drop("_next", "_day")


def moving_measure(days: DataFrame, keys: list[str], measure: str, span: int = 7, day: str = "trip_date") -> DataFrame:
    """Add the sum and mean of the last `span` calendar days and the change to the day and to the `span` days before.

    The frames are ranges of days, not of rows, so days without a row count as
    zero. The mean is over the days since the key's first one, `span` at most; the
    changes are NULL where the day they refer to lies before the first one.
    """
    ordered = Window.partitionBy(*keys).orderBy(F.unix_date(day))

    def days_back(first: int, last: int) -> Column:
        return F.coalesce(F.sum(measure).over(ordered.rangeBetween(-first, -last)), F.lit(0))

    known = F.datediff(day, F.min(day).over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))) + 1
    moved = days.withColumns({
        "days_known": F.least(known, F.lit(span)),
        "moving_sum": F.sum(measure).over(ordered.rangeBetween(-(span - 1), Window.currentRow)),
        "change_to_day": F.when(known > 1, F.col(measure) - days_back(1, 1)),
        "change_to_span": F.when(known > span, F.col(measure) - days_back(span, span)),
    })
    return moved.withColumn("moving_avg", F.col("moving_sum") / F.col("days_known"))


def running_amount(days: DataFrame, keys: list[str], amount: str, day: str = "trip_date") -> DataFrame:
    """Add the amount of a key so far, day by day, and its share of the key's whole. Sums are exact; amounts of 1e18 and
    more are not accepted."""
    whole = Window.partitionBy(*keys)
    exact = F.col(amount).cast(MONEY)
    so_far = F.sum(exact).over(whole.orderBy(day).rangeBetween(Window.unboundedPreceding, Window.currentRow)).cast("double")
    all_ = F.sum(exact).over(whole.orderBy(day).rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)).cast("double")
    return days.withColumns({"running_amount": so_far, "share_of_whole": so_far / F.nullif(all_, F.lit(0.0))})
