"""Approximate distinct counts and quantiles kept as mergeable state.

A month's sketches are a few kilobytes, however many trips it had. They are
stored with the marts, replaced with their month, and merged for any range of
months without reading a trip again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** LG_REGISTERS registers: a relative standard error of 1.04 / sqrt(2 ** LG_REGISTERS), 1.6 %.
LG_REGISTERS = 12
#: KLL accuracy: with 200 a rank is off by 1.65 % at most in 99 of 100 sketches.
QUANTILE_K = 200


def month_sketches(rows: DataFrame, groups: list[str], counted: list[str], measured: str) -> DataFrame:
    """Per group: row_count, the sketch of distinct values of the `counted` columns together (rows with a NULL among
    them are not counted) and that of the `measured` values (NULL and NaN are not). A group without values has an empty
    sketch or none."""
    known = F.lit(True)
    for name in counted:
        known = known & F.col(name).isNotNull()
    value = F.when(known, F.to_json(F.struct(*counted)))
    amount = F.col(measured).cast("double")
    return rows.groupBy(*groups).agg(
        F.count("*").alias("row_count"),
        F.hll_sketch_agg(value, F.lit(LG_REGISTERS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.when(~F.isnan(amount), amount), F.lit(QUANTILE_K)).alias("value_sketch"),
    )


def merged(sketches: DataFrame, groups: list[Column] | list[str]) -> DataFrame:
    """Sketches of larger groups from stored ones, by the same rules."""
    return sketches.groupBy(*groups).agg(
        F.sum("row_count").alias("row_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    )


def estimates(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """The groups with `distinct_estimate` and an array `quantiles` at the given ranks."""
    points = F.array(*[F.lit(rank).cast("double") for rank in ranks])
    return sketches.withColumns({
        "distinct_estimate": F.hll_sketch_estimate("distinct_sketch"),
        "quantiles": F.kll_sketch_get_quantile_double("value_sketch", points),
    }).drop("distinct_sketch", "value_sketch")
