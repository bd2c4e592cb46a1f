"""Totals at several levels in one pass."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subtotals(df: DataFrame, levels: list[list[str]], measures: list[Column]) -> DataFrame:
    """Measures at every level: the columns of a level keep their values, the others are NULL, and `level` tells which.

    One Expand repeats each row for each level and one shuffle adds them up, after
    adding up what a task has. `level` has a bit for every grouping column, in the
    order they first occur, the first one highest; a bit is set where the column is
    added over, so a NULL value and a total are told apart. An empty input gives no
    rows, not even a grand total.
    """
    columns = list(dict.fromkeys(name for level in levels for name in level))
    sets = [[F.col(name) for name in level] for level in levels]
    return df.groupingSets(sets, *columns).agg(*measures, F.grouping_id().cast("int").alias("level"))


def rollup_levels(columns: list[str]) -> list[list[str]]:
    """From the finest level to the grand total."""
    return [columns[:size] for size in range(len(columns), -1, -1)]


def side_by_side(df: DataFrame, rows: list[str], column: str, values: list, measure: Column, prefix: str) -> DataFrame:
    """One column per given value, named by prefix and value: values are stated, so no pass looks for them. Rows with
    another value or none add to nothing."""
    pivoted = df.groupBy(*rows).pivot(column, values).agg(measure)
    return reduce(lambda out, value: out.withColumnRenamed(str(value), f"{prefix}{value}"), values, pivoted)
