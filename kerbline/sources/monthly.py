"""Monthly Parquet files whose schema drifts over the years."""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbline import schemas

_SCHEMA_JOBS = 8


def conform(df: DataFrame, contract: str, lenient: bool = False) -> DataFrame:
    """Give the frame the contract's columns, spelling and types.

    Columns are matched without regard to case, absent ones become NULL and
    columns the contract does not know are kept after the known ones. A value
    that does not fit raises, or becomes NULL with `lenient`.
    """
    present = {name.lower(): name for name in df.columns}
    known = StructType.fromDDL(contract)
    columns = []
    for field in known:
        source = present.pop(field.name.lower(), None)
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        if source is None or df.schema[source].dataType != field.dataType:
            value = value.try_cast(field.dataType) if lenient else value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *[F.col(f"`{name}`") for name in present.values()])


def _merged_schema(spark: SparkSession, paths: list[str]) -> StructType:
    return spark.read.option("mergeSchema", True).parquet(*paths).schema


def _group_by_schema(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The fewest groups of paths that one reader each can scan, with their schema.

    Footers are merged by a Spark job over all files. Months that only add columns
    make one group; where types conflict, every month is asked for its own schema.
    """
    try:
        return [(_merged_schema(spark, paths), paths)]
    except (PySparkException, Py4JJavaError) as conflict:  # this error reaches Python unconverted
        if "CANNOT_MERGE_SCHEMAS" not in str(conflict):
            raise
    with ThreadPoolExecutor(_SCHEMA_JOBS) as jobs:
        found = list(jobs.map(lambda path: _merged_schema(spark, [path]), paths))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path, schema in zip(paths, found):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(groups.values())


def scan_months(
    spark: SparkSession, paths: list[str], contract: str = schemas.RAW_TRIP, lenient: bool = False
) -> DataFrame:
    """All files as one relation, plus the `source_file` each row came from.

    One reader over files of conflicting types fails when it runs, so there is one
    scan per group of months that agree, each cast to the contract and then united
    by name. Only footers are read here.
    """
    scans = []
    for schema, group in _group_by_schema(spark, paths):
        files = spark.read.schema(schema).parquet(*group)
        files = files.select("*", F.col("_metadata.file_path").alias("source_file"))
        scans.append(conform(files, contract, lenient))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), scans)
