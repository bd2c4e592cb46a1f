"""Writers: append a batch, replace a table, replace some months.

Columns new to a table are accepted on every write: formats that keep a table
schema need the mergeSchema option for that, plain Parquet does not look at it. Parquet
is written under zstd: stored trips take about a quarter less than under Spark's default.
"""

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F


def _writer(df: DataFrame, fmt: str, mode: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode(mode).option("mergeSchema", True)
    return writer.option("compression", "zstd") if fmt == "parquet" else writer


def gather_months(df: DataFrame, column: str) -> DataFrame:
    """Bring rows of a month together before a partitioned write.

    Adaptive execution cuts a month too big for one task and merges months too
    small for one, so neither a dominant month nor a long history of thin ones
    ends in one straggling task or in tasks x months tiny files.
    """
    return df.hint("rebalance", column)


def append_batch(df: DataFrame, path: str, batch_column: str = "batch_id", fmt: str = "parquet") -> None:
    """Add a load; the table is the union of its batches."""
    _writer(df, fmt, "append").partitionBy(batch_column).save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", column: str | None = None) -> None:
    """Replace the whole table, partitioned by `column` if given."""
    writer = _writer(df, fmt, "overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(column) if column else writer).save(path)


def replace_months(
    df: DataFrame,
    path: str,
    column: str,
    gather: bool = True,
    fmt: str = "parquet",
    months: list[str] | None = None,
) -> None:
    """Replace the months present in `df` and leave every other month alone.

    Of the months named in `months`, those without a row in `df` are emptied: a
    dynamic overwrite alone would leave their old rows. Which months had rows is
    noted by the write itself, one short value each; only where some had none is
    the table asked which of those hold rows, and these get an empty file.

    `gather=False` saves the shuffle where rows already come month by month or
    span only a few months. The overwrite mode is an option of this write; the
    session keeps its own.
    """
    if gather:
        df = gather_months(df, column)
    writer = _writer(df, fmt, "overwrite").partitionBy(column)
    if fmt != "parquet" and months:
        named = ", ".join(f"'{month}'" for month in months)
        writer.option("replaceWhere", f"{column} IN ({named})").save(path)
        return
    if not months:
        writer.option("partitionOverwriteMode", "dynamic").save(path)
        return
    written = Observation()
    writer = _writer(df.observe(written, F.collect_set(column).alias("months")), fmt, "overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    without = sorted(set(months) - set(written.get["months"]))
    if without:
        _empty_months(df, path, column, without)


def _empty_months(df: DataFrame, path: str, column: str, months: list[str]) -> None:
    spark = df.sparkSession
    stored = spark.read.schema(f"{column} string").parquet(path).where(F.col(column).isin(months))
    nothing = spark.createDataFrame([], df.drop(column).schema).coalesce(1)
    for row in stored.select(column).distinct().collect():
        nothing.write.mode("overwrite").parquet(f"{path}/{column}={row[0]}")
