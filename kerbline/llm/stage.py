"""Written tables between the steps of an operator, in the folder the whole cluster shares."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir where it is set, else a folder of this application's own in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    return base.rstrip("/")


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the path of Python workers started from now on. Where executors do not see it, the
    package has to be installed there, as for any job."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def store(frame: DataFrame) -> DataFrame:
    """Write a frame once and read it back: later steps neither repeat the work nor depend on an executor's memory."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
