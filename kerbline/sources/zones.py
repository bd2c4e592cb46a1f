"""The zone lookup CSV."""

from pyspark.sql import DataFrame, SparkSession

from kerbline import schemas


def scan_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column text; blanks are NULL and the text N/A stays text."""
    return spark.read.option("header", True).schema(schemas.RAW_ZONE).csv(path)
