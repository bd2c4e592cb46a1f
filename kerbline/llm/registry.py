"""One query per operator over its whole table, as the driver's checks run them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import conversations, decontamination, fingerprints, language_model, line_dedup, mixing, near_dedup, oracle, piece_encoding, quality, substring_dedup, token_files, toxicity, whitening
from kerbline.llm.stage import let_workers_import, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.array_join("removed", ","))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = token_files.write_tokens(table(spark, sf_dir, "documents"), token_files.default_tokenizer())
    return token_files.read_tokens(segments)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, host=docs["source"], path=docs["lang"])


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_score_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report_all(rows, conversations.damage(rows))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that no long holds is null here; the operator returns it as a decimal."""
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_encoding.encode_texts(table(spark, sf_dir, "documents"), piece_encoding.default_model())
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _with_workers(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _with_workers(query) for name, query in globals().items() if name.startswith("op") and callable(query)}


def oracle_sql() -> dict[str, str]:
    """The other operators rest on hashes, samples, models or tokenizers that SQL has no equal for."""
    return {"op1_line_dedup": oracle.LINE_DEDUP, "op4_suffix_dedup": oracle.SUFFIX_DEDUP}
