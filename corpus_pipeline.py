"""From raw documents to token files: what a training corpus goes through, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbline.llm import decontamination, mixing, near_dedup, token_files, toxicity
from kerbline.llm.stage import let_workers_import, store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it is trained on the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated where a source is drawn on more than once."""
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token segments on shared storage, and what reading them back gives for each document."""
    return token_files.read_tokens(token_files.write_tokens(docs, token_files.default_tokenizer()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", write_token_files),
]

#: The classifier, the sketches, the singular vectors and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    let_workers_import(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
