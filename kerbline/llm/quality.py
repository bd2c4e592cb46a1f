"""Document quality by hierarchical empirical Bayes.

A classifier gives each document a chance of being good from its own text alone. Sites tell more: a host's documents are
summed up, its mean shrunk toward the mean of all hosts by as much as hosts differ beyond chance, and each path of a host is
shrunk toward its host in the same way. A document's score adds the log odds of its text to those of its path, without
its own part in the path's sum. All of it is grouped sums: one row per host and path leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.hashing import slices, text_bytes, word_hashes
from kerbline.llm.stage import store

#: Labelled documents that training may see: those with the smallest hashes of their ids.
MOST_LABELLED = 20_000
HELD_OUT_OF = 5
RIDGE = 1.0
_CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "point": b".", "comma": b",", "pipe": b"|",
    "symbol": b"#$%&*@^~+=<>{}[]\\_/", "mark": b"!?;:'\"()-", "break": b"\n", "space": b" \t", "far": range(128, 256),
}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _number, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _number
FEATURES = 2 * (len(_CLASSES) + 1) + 5


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT_OF == 0


def features(column: pa.Array) -> np.ndarray:
    """One row per text: shares of character classes and their roots, length, word length, shares of distinct words and
    of repeated words, mean distance of equal neighbours. An empty text is a row of zeros."""
    data, offsets = text_bytes(column)
    hashes, firsts = word_hashes(data, offsets)
    size, count = np.diff(offsets), np.diff(firsts)
    rows = len(size)
    kinds = len(_CLASSES) + 1
    text = np.repeat(np.arange(rows), size)
    shares = np.bincount(text * kinds + _CLASS_OF[data], minlength=rows * kinds).reshape(rows, kinds) / np.maximum(size, 1)[:, None]
    word_text = np.repeat(np.arange(rows), count)
    order = np.lexsort((hashes, word_text))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (word_text[order][1:] != word_text[order][:-1])
    distinct = np.bincount(word_text[order][new], minlength=rows)
    run = np.diff(np.append(np.flatnonzero(new), len(hashes)))
    single = np.bincount(word_text[order][new][run == 1], minlength=rows)
    twice = np.zeros(len(hashes), bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (word_text[1:] == word_text[:-1])
    words = np.maximum(count, 1)
    extra = [np.log1p(count), np.log1p(size / words), distinct / words, single / words, np.bincount(word_text[twice], minlength=rows) / words]
    out = np.column_stack([shares, np.sqrt(shares), *extra])
    out[size == 0] = 0
    return out


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: means, scales and weights (the bias first)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    weights = np.zeros(z.shape[1])
    ridge = np.diag(np.r_[1e-6, np.full(z.shape[1] - 1, RIDGE)])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (chance - y) + ridge @ weights
        weights -= np.linalg.solve(z.T @ (z * (chance * (1 - chance))[:, None]) + ridge, slope)
    return mean, scale, weights


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple:
    """Fit on the bounded sample of labelled rows; their features, FEATURES numbers each, come to the driver. Without
    both classes every text has the share of good labels (0.5 if there is none)."""
    known = (
        labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MOST_LABELLED)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                x = [row.tobytes() for row in features(piece.column("text"))]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("y"), pa.array(x, pa.binary())], ["doc_id", "y", "x"])

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sample = texts.join(F.broadcast(known), "doc_id").mapInArrow(run, "doc_id long, y double, x binary")  # MOST_LABELLED rows of two numbers
    rows = sample.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).orderBy("doc_id").collect()
    y = np.array([row["y"] for row in rows])
    if len(y) and 0 < y.sum() < len(y):
        return fit(np.array([np.frombuffer(row["x"]) for row in rows]), y)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    return np.zeros(FEATURES), np.ones(FEATURES), np.r_[np.log(share / (1 - share)), np.zeros(FEATURES)]


def text_chances(docs: DataFrame, model: tuple, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path and p, the chance of being good by the text alone, between 0.001 and 0.999."""
    mean, scale, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                z = np.clip((features(piece.column("text")) - mean) / scale, -8, 8)
                p = np.clip(1 / (1 + np.exp(-np.clip(weights[0] + z @ weights[1:], -30, 30))), 0.001, 0.999)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("doc_id", "host", "path")), pa.array(p)], ["doc_id", "host", "path", "p"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, host string, path string, p double")


def _strength(groups: DataFrame, prior: Column) -> DataFrame:
    """How many documents the prior is worth, from groups (n, s): the variance between group means beyond what n draws
    around the prior would show, by moments. One row: strength."""
    excess = F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - prior, F.lit(2))) - F.sum(prior * (1 - prior))
    spread = F.greatest(excess / F.greatest(F.sum("n"), F.lit(1)), F.lit(1e-6))
    return groups.agg(F.coalesce(F.greatest(F.avg(prior * (1 - prior)) / spread - 1, F.lit(1.0)), F.lit(1.0)).alias("strength"))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def score_documents(docs: DataFrame, model: tuple, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_chance, host_posterior, path_posterior, score and keep (score of 0.5 or more) of every row.

    A null host or path is a site of its own. A site of one document has no evidence but its host's (or the global
    mean). Null or empty texts have a row of zeros as features. Null ids and repeated rows are kept. An empty table gives
    an empty result. Only the named columns and those of the site expressions are read.
    """
    texts = store(text_chances(docs, model, id_col, text_col, host, path))
    everything = texts.agg(F.avg("p")).first()[0]
    mean = F.lit(float(everything) if everything is not None else 0.5)
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    host_strength = F.lit(_strength(hosts, mean).first()["strength"])
    hosts = store(hosts.select(F.col("host").alias("h"), ((F.col("s") + host_strength * mean) / (F.col("n") + host_strength)).alias("host_posterior")))
    paths = texts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    paths = store(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"))
    path_strength = F.lit(_strength(paths, F.col("host_posterior")).first()["strength"])
    sites = paths.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "host_posterior")
    joined = texts.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    others = (F.col("s") - F.col("p") + path_strength * F.col("host_posterior")) / (F.col("n") - 1 + path_strength)
    others = F.least(F.greatest(others, F.lit(0.001)), F.lit(0.999))
    score = 1 / (1 + F.exp(-(_logit(F.col("p")) + _logit(others) - _logit(F.least(F.greatest(mean, F.lit(0.001)), F.lit(0.999))))))
    return joined.select("doc_id", F.col("p").alias("text_chance"), "host_posterior", others.alias("path_posterior"), score.alias("score")).withColumn(
        "keep", F.col("score") >= 0.5
    )
