"""Operator 10: held-out accuracy on the supplied labels, and scores and training steps against plain versions."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbline.llm import hashing, toxicity

SF = "/root/testdata/sf0.1"


def _rows_of(word):
    """Buckets of a word's rows with their shares, one by one."""
    raw = word.encode()
    parts = [(raw[i : i + n], (i == 0) + 2 * (i + n == len(raw))) for n in toxicity.GRAMS for i in range(len(raw) - n + 1)]

    def number(piece):
        data = np.frombuffer(piece, np.uint8)
        return hashing.range_hash(hashing.prefix_hash(data), np.array([0]), np.array([len(data)]))

    own = int(number(raw)[0]) & (toxicity.BUCKETS - 1)
    grams = [int(hashing.mix(number(part) + np.uint64(touch))[0]) & (toxicity.BUCKETS - 1) for part, touch in parts]
    if not grams:
        return [(own, 1.0)]
    return [(own, toxicity.OWN), *((gram, (1 - toxicity.OWN) / len(grams)) for gram in grams)]


def _plain_score(text, table, bias):
    words = text.lower().split()
    means = []
    for at in range(0, len(words), toxicity.PASSAGE):
        some = words[at : at + toxicity.PASSAGE]
        means.append(sum(float(table[bucket]) * share for word in some for bucket, share in _rows_of(word)) / len(some))
    return 1 / (1 + math.exp(-(max(means, default=0.0) + bias)))


def test_scores_equal_a_plain_version(spark):
    table = np.random.default_rng(0).normal(0, 3, toxicity.BUCKETS).astype(np.float32)
    texts = ["", "a", "to be or not", "One two three four five six seven", "über 😀 grüße a b", "same same same", "x" * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for row in toxicity.score_texts(docs, (table, -0.3)).collect():
        assert row.score == pytest.approx(_plain_score(texts[row.doc_id], table, -0.3), abs=1e-6)


def test_a_training_step_equals_the_plain_formulas(monkeypatch):
    """One epoch of one batch: the slopes of the loss over each text's worst passage, by hand."""
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    texts, labels, weights = ["bad words here", "fine text", ""], np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])
    got, bias = toxicity.fit(pa.array(texts), labels, weights, seed=1)
    random = np.random.default_rng(1)
    head = random.normal(0, 0.1, toxicity.DIMENSIONS)
    # Embeddings begin at zero: all passages tie, the first is taken, each chance is one half.
    slopes = {}
    for text, label, weight in zip(texts[:2], labels, weights):
        some = text.split()[: toxicity.PASSAGE]
        for word in some:
            for bucket, share in _rows_of(word):
                slopes[bucket] = slopes.get(bucket, 0.0) + share / len(some) * (0.5 - label) * weight
    norm = head @ head
    for bucket, slope in slopes.items():
        step = slope / math.sqrt(toxicity.CAUTION + slope**2 * norm)
        assert got[bucket] == pytest.approx(-step * norm, rel=1e-4)
    assert np.count_nonzero(got) == len(slopes)
    error = (0.5 - 1) * 1 + 0.5 * 2
    assert bias == pytest.approx(-error / math.sqrt(1e-8 + error**2))


def test_held_out_texts_of_the_supplied_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.score_texts(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("toxic is not null")
    held = scored.where(toxicity.held_out(F.col("doc_id"))).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    toxic, clean = [r.predicted for r in held if r.toxic], [r.predicted for r in held if not r.toxic]
    print("recall", np.mean(toxic), "false alarms", np.mean(clean))
    assert np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.02


def test_words_of_several_slices_are_held_once(monkeypatch):
    """Texts cut into slices of a row each give the same passages and rows as one slice."""
    texts = pa.array(["one two three", "", "two three four two", "five", "one"])
    whole = toxicity._Words(texts)
    monkeypatch.setattr(toxicity, "slices", lambda batch, column: (batch.slice(row, 1) for row in range(batch.num_rows)))
    cut = toxicity._Words(texts)
    assert cut.bounds.tolist() == whole.bounds.tolist() == [0, 2, 3, 5, 7, 8, 9]
    assert cut.spans.tolist() == whole.spans.tolist() == [0, 2, 2, 4, 5, 6]
    assert len(cut.ends) == len(whole.ends) == 6
    for mine, other in zip(cut.of, whole.of, strict=True):
        rows = [known.rows(np.array([number]))[0] for known, number in ((cut, mine), (whole, other))]
        assert cut.buckets[rows[0]].tolist() == whole.buckets[rows[1]].tolist()
        assert cut.shares[rows[0]].tolist() == whole.shares[rows[1]].tolist()
