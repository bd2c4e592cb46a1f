"""Corrections put into a table partitioned by month: only months that hold a corrected row are written anew."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.trips import month_key
from kerbline.sinks import replace_months
from kerbline.sources.tables import load_table


def _same(keys: list[str]) -> Column:
    matches = F.lit(True)
    for key in keys:
        matches = matches & F.col(f"t.{key}").eqNullSafe(F.col(f"c.{key}"))
    return matches


def corrected(table: DataFrame, corrections: DataFrame, keys: list[str], order: list[Column], delete: str | None = None) -> DataFrame:
    """The table with corrections put in: a row of a known key replaces it, one of a new key is added, and one whose
    `delete` column is true takes its key away.

    Of several corrections of a key the first under `order` counts. NULL key values
    are values. The result has the table's columns; corrections need the same ones.
    """
    ranked = corrections.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    last = ranked.where(F.col("_nth") == 1)
    kept = table.alias("t").join(last.alias("c"), _same(keys), "left_anti")
    added = last.where(~F.coalesce(F.col(delete), F.lit(False))) if delete else last
    return kept.unionByName(added.select(*table.columns))


def upsert_months(
    corrections: DataFrame,
    path: str,
    contract: str,
    keys: list[str],
    order: list[Column],
    month_column: str,
    time_key: str,
    delete: str | None = None,
) -> list[str]:
    """Put corrections into the stored table and return the months written.

    The key holds the time that the month follows from (`time_key`), so the months
    concerned are known from the corrections alone, one short value each, and only
    their partitions are read. Their new content is stored beside the table before it
    replaces the old one. Readers see a month's old or new files.
    """
    spark = corrections.sparkSession
    dated = corrections.withColumn(month_column, month_key(time_key))
    months = sorted(row[0] for row in dated.select(month_column).distinct().collect() if row[0] is not None)
    if not months:
        return []
    table = load_table(spark, path, contract).where(F.col(month_column).isin(months))
    stage = f"{path}__corrected"
    corrected(table, dated, keys, order, delete).write.mode("overwrite").parquet(stage)
    replace_months(spark.read.schema(contract).parquet(stage), path, month_column, months=months)
    return months
