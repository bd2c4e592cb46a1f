"""Rows whose time spans overlap: as pairs by time bins, or as counts by events.

Spans are half open: one that ends when another begins does not overlap it, and
one that ends no later than it begins overlaps nothing.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _binned(df: DataFrame, side: str, keys: list[str], span: tuple[str, str], step: int) -> DataFrame:
    start, end = _micros(span[0]), _micros(span[1])
    bins = F.sequence(F.floor(start / F.lit(step)), F.floor((end - 1) / F.lit(step)))
    return df.where(start < end).select(
        *[F.col(key).alias(f"_{side}_{i}") for i, key in enumerate(keys)],
        start.alias(f"_{side}_start"),
        end.alias(f"_{side}_end"),
        F.struct(*df.columns).alias(side),
        F.explode(bins).alias(f"_{side}_bin"),
    )


def overlapping_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    bin_seconds: int,
    condition: Column | None = None,
) -> DataFrame:
    """Pairs with equal keys and overlapping spans, as the structs `left` and `right`, with `overlap_start` and
    `overlap_seconds`.

    Every row is repeated for each bin its span touches, and rows meet by key and
    bin: an equi-join, which Spark splits where a key and bin are hot. A pair counts
    only in the bin where its overlap begins, so it comes once. Bins about as long
    as a usual span keep both the repetition and the non-matching meetings low.
    NULL keys match nothing. `condition` may use `left.x` and `right.y`; for a
    self-join it has to order the two rows.
    """
    step = bin_seconds * 1_000_000
    one, two = _binned(left, "left", keys, left_span, step), _binned(right, "right", keys, right_span, step)
    start, end = F.greatest("_left_start", "_right_start"), F.least("_left_end", "_right_end")
    matches = F.col("_left_bin") == F.col("_right_bin")
    for i in range(len(keys)):
        matches = matches & (F.col(f"_left_{i}") == F.col(f"_right_{i}"))
    matches = matches & (start < end) & (F.floor(start / F.lit(step)) == F.col("_left_bin"))
    if condition is not None:
        matches = matches & condition
    return one.join(two, matches).select(
        "left", "right", F.timestamp_micros(start).alias("overlap_start"), ((end - start) / F.lit(1e6)).alias("overlap_seconds")
    )


def under_way(rows: DataFrame, keys: list[str], span: tuple[str, str], range_seconds: int = 86_400) -> DataFrame:
    """Per key and instant at which spans begin or end: begun, ended, and how many are under way just before and after it.

    Equal instants are added up before the shuffle. The running count of a key is
    taken in time ranges by different tasks; each starts from the sum of the ranges
    before, one number each, so a key may hold any share of the rows. Rows without a
    key or time are left out.
    """
    step = range_seconds * 1_000_000
    spans = rows.where(_micros(span[0]) < _micros(span[1]))
    for key in keys:
        spans = spans.where(F.col(key).isNotNull())
    ends = F.explode(F.array(F.struct(_micros(span[0]).alias("t"), F.lit(1).alias("d")), F.struct(_micros(span[1]).alias("t"), F.lit(-1).alias("d"))))
    events = spans.select(*keys, ends.alias("_e")).groupBy(*keys, F.col("_e.t").alias("_t"))
    counted = events.agg(F.count_if(F.col("_e.d") > 0).alias("begun"), F.count_if(F.col("_e.d") < 0).alias("ended"))
    counted = counted.withColumn("_range", F.floor(F.col("_t") / F.lit(step)))
    net = F.col("begun") - F.col("ended")
    totals = counted.groupBy(*keys, "_range").agg(F.sum(net).alias("_net"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_range", F.coalesce(F.sum("_net").over(before), F.lit(0)).alias("_carried"))
    # The carried number enters its range as a row before all others.
    merged = counted.unionByName(carried, allowMissingColumns=True)
    ordered = Window.partitionBy(*keys, "_range").orderBy(F.asc_nulls_first("_t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.sum(F.coalesce(F.col("_carried"), net)).over(ordered)
    running = merged.withColumn("after", after).where(F.col("_t").isNotNull())
    return running.select(*keys, F.timestamp_micros("_t").alias("instant"), "begun", "ended", (F.col("after") - net).alias("before"), "after")


def pairs_begun() -> Column:
    """Of a row of `under_way`: how many overlapping pairs begin there. What begins meets what goes on and each other."""
    going_on, begun = F.col("before") - F.col("ended"), F.col("begun")
    return going_on * begun + F.floor(begun * (begun - 1) / 2)
