"""Stored tables addressed by path, and their names for SQL."""

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a file, and of a shuffle, that one task takes where it sorts trips: a stored trip takes some 20 to 40 bytes of
#: its file, 50 to 70 of a shuffle, and 300 to 450 in a sort.
TASK_LIMITS = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]?)[a-z]*\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit if unit not in ("", "b") else " ")


def bound_tasks(spark: SparkSession) -> dict[str, str]:
    """Jobs run from now on give a task no more of a file or a merged shuffle than TASK_LIMITS, unless the session's limits
    are lower yet; returns the limits there were. Tasks that sort what they take, as a dedup and a write by month do, then
    hold it in memory however large the table is."""
    before = {name: spark.conf.get(name) for name in TASK_LIMITS}
    for name, size in TASK_LIMITS.items():
        if _bytes(before[name]) > _bytes(size):
            spark.conf.set(name, size)
    return before


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """`bound_tasks` for the jobs run inside."""
    before = bound_tasks(spark)
    try:
        yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def load_table(spark: SparkSession, path: str, contract: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan a stored table; `contract` fixes its columns and types."""
    reader = spark.read.format(fmt)
    if contract and fmt == "parquet":
        reader = reader.schema(contract)
    return reader.load(path)


def only_months(df: DataFrame, months: list[str] | None, column: str) -> DataFrame:
    """Keep some months of a month-partitioned table; no months means all.

    A plain IN on the partition column: other months' directories are not listed
    for reading.
    """
    return df.where(F.col(column).isin(sorted(set(months)))) if months else df


def register_views(tables: dict[str, DataFrame]) -> None:
    """Bind each table to its bare name, so SQL text can use it."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
