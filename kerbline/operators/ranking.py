"""Ranks over a whole relation without one task holding all of it."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_dense_rank(df: DataFrame, measure: str, tie_break: list[str], k: int, rank: str) -> DataFrame:
    """The k highest rows with their dense rank over all rows.

    Taking the top k first is exact: every value above a kept row is itself kept,
    so the rank among the k rows equals the rank among all. Only k rows meet in
    the unpartitioned window.
    """
    top = df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(c) for c in tie_break]).limit(k)
    return top.withColumn(rank, F.dense_rank().over(Window.orderBy(F.desc_nulls_last(measure))))


def _cuts(values: DataFrame, column: str, buckets: int) -> list[float]:
    """Quantiles of distinct values: bounds of ranges that hold about equally many. At most `buckets` numbers."""
    found = values.agg(F.percentile_approx(column, [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0]
    return sorted({float(cut) for cut in found or [] if cut == cut})


def dense_rank_desc(df: DataFrame, measure: str, rank: str, buckets: int = 256) -> DataFrame:
    """Dense rank of every row by a numeric measure, highest first, in parallel.

    Distinct values are numbered inside ranges and start after the values of the
    ranges above; rows then look their value's rank up. The ranges are quantiles of
    the distinct values, asked for when the rank is planned, so values that lie
    close together still spread over `buckets` tasks. A value that many rows share
    is numbered once. NaN ranks above all numbers, NULLs share the last rank.
    """
    values = df.select(F.col(measure).alias("_value")).distinct()
    cuts = F.array(*[F.lit(cut) for cut in _cuts(values, "_value", buckets)]).cast("array<double>")
    above_cuts = F.size(F.filter(cuts, lambda cut: F.col("_value") > cut))
    bucket = F.when(F.col("_value").isNull(), -1).otherwise(above_cuts)
    values = values.withColumn("_bucket", bucket)
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.desc_nulls_last("_value")))
    above = F.sum("_n").over(Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1))
    offsets = values.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = offsets.select(F.col("_bucket").alias("_of"), F.coalesce(above, F.lit(0)).alias("_above"))
    ranks = values.withColumn("_inside", inside).join(F.broadcast(offsets), F.col("_bucket") == F.col("_of"))  # `buckets` rows
    ranks = ranks.select("_value", (F.col("_above") + F.col("_inside")).cast("int").alias(rank))
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_value"))).drop("_value")
