"""Toxicity by subword-bag embeddings.

A word is the bag of its character n-grams (3 to 5 bytes of UTF-8, marked where they touch the ends) and itself, hashed to
embedding rows. A word is the average of its n-grams and, with a share of OWN, of its own row; a passage of PASSAGE words is
the average of its words, and a linear softmax over two classes reads the average. A text is as toxic as its worst
passage, so that a short insult counts the same in a long text. Embeddings and softmax are trained together, on the
passage that is worst at the time. A misspelt or inflected word that was never seen still has most n-grams of its
known forms; what no n-gram tells adds nothing, since embeddings begin at zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.hashing import mix, prefix_hash, range_hash, slices, text_bytes, words

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMENSIONS = 8
EPOCHS = 15
PASSAGE = 2
OWN = 0.3
RATE = 1.0
#: Sum of squared slopes that every embedding begins with: what few texts use is learnt slowly.
CAUTION = 1.0
BATCH_DOCS = 64
#: Labelled documents that training may see, by class; those with the smallest hashes of their ids.
MOST_TOXIC, MOST_CLEAN = 2_000, 6_000
HELD_OUT_OF = 5


def held_out(doc_id: Column, modulus: int = HELD_OUT_OF) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == 0


def _distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts: the number of each word among the distinct ones, the n + 1 word offsets, and for the rows of
    the distinct words their buckets, the distinct word they belong to and their shares of it; and the distinct words' hashes."""
    data, offsets = text_bytes(column)
    starts, ends, firsts = words(data, offsets)
    prefix = prefix_hash(data)
    hashes = range_hash(prefix, starts, ends)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    begin, end = starts[first], ends[first]
    buckets, owners = [hashes[first] & np.uint64(BUCKETS - 1)], [np.arange(len(first))]
    for size in GRAMS:
        count = np.maximum(end - begin - size + 1, 0)
        owner = np.repeat(np.arange(len(first)), count)
        at = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        touches = (at == begin[owner]).astype(np.uint64) + np.uint64(2) * (at + size == end[owner]).astype(np.uint64)
        buckets.append(mix(range_hash(prefix, at, at + size) + touches) & np.uint64(BUCKETS - 1))
        owners.append(owner)
    owner = np.concatenate(owners)
    grams = np.bincount(owner, minlength=len(first)) - 1
    own = np.arange(len(owner)) < len(first)
    share = np.where(own, np.where(grams[owner] > 0, OWN, 1.0), (1 - OWN) / np.maximum(grams[owner], 1))
    return inverse, firsts, np.concatenate(buckets).astype(np.int64), owner, share, distinct


def _passages(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word offsets of the passages and the n + 1 passage offsets of the texts; a text without words has no passage."""
    counts = np.diff(firsts)
    many = -(-counts // PASSAGE)
    text = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return np.append(firsts[text] + nth * PASSAGE, firsts[-1]), np.concatenate([[0], np.cumsum(many)])


class _Words:
    """The words of all training texts: each distinct word's rows once, and the texts as numbers of words. What a passage
    adds up is looked up in them when it is trained on, so memory grows with words, not with the n-grams of all texts."""

    def __init__(self, texts: pa.Array) -> None:
        known, numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        of, bounds, spans, buckets, shares, rows = [], [], [np.zeros(1, np.int64)], [], [], []
        count = passages = 0
        for piece in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            inverse, firsts, bucket, owner, share, distinct = _distinct_words(pc.utf8_lower(piece.column("text")))
            place = np.searchsorted(known, distinct)
            new = np.ones(len(distinct), bool)
            new[place < len(known)] = known[place[place < len(known)]] != distinct[place < len(known)]
            number = np.zeros(len(distinct), np.int64)
            number[~new] = numbers[place[~new]]
            number[new] = len(known) + np.arange(np.count_nonzero(new))
            known, numbers = np.insert(known, place[new], distinct[new]), np.insert(numbers, place[new], number[new])
            order = np.argsort(owner, kind="stable")
            order = order[new[owner[order]]]
            buckets.append(bucket[order].astype(np.int32))
            shares.append(share[order].astype(np.float32))
            rows.append(np.bincount(owner, minlength=len(distinct))[new])
            of.append(number[inverse].astype(np.int32))
            begins, span = _passages(firsts)
            bounds.append(begins[:-1] + count)
            spans.append(span[1:] + passages)
            count, passages = count + len(inverse), passages + int(span[-1])
        #: Number of each word of the texts; word offsets of the passages; passage offsets of the texts.
        self.of, self.bounds, self.spans = np.concatenate([np.zeros(0, np.int32), *of]), np.concatenate([*bounds, [count]]), np.concatenate(spans)
        #: Row offsets of the distinct words, and the rows' buckets and shares.
        self.ends = np.cumsum(np.concatenate([[0], *rows])).astype(np.int64)
        self.buckets, self.shares = np.concatenate([np.zeros(0, np.int32), *buckets]), np.concatenate([np.zeros(0, np.float32), *shares])

    def rows(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows of some words, one word after another, and how many each has."""
        sizes = self.ends[numbers + 1] - self.ends[numbers]
        return _ranges(self.ends[numbers], sizes), sizes


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers of all ranges, one range after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _worst(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Place of the first largest value of each of the groups that follow one another."""
    most = np.maximum.reduceat(chances, np.cumsum(sizes) - sizes)
    group = np.repeat(np.arange(len(sizes)), sizes)
    largest = np.flatnonzero(chances == most[group])
    return largest[np.unique(group[largest], return_index=True)[1]]


def fit(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax by Adagrad; return the two classes' difference that each bucket contributes, and the
    bias. (With two classes the gradient of an embedding is a multiple of the difference of the softmax's columns.)"""
    known = _Words(texts)
    span = known.spans
    random = np.random.default_rng(seed)
    table = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    head, bias = random.normal(0, 0.1, DIMENSIONS), 0.0
    past, head_past, bias_past = np.full(BUCKETS, CAUTION), np.full(DIMENSIONS, 1e-8), 1e-8
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(labels))
        for begin in range(0, len(labels), BATCH_DOCS):
            docs = order[begin : begin + BATCH_DOCS]
            docs = docs[span[docs + 1] > span[docs]]
            if not len(docs):
                continue
            held = span[docs + 1] - span[docs]
            own = _ranges(span[docs], held)
            counts = known.bounds[own + 1] - known.bounds[own]
            word, of = np.unique(known.of[_ranges(known.bounds[own], counts)], return_inverse=True)
            # Which passage is worst needs one number a word; vectors are added up for the worst passages alone.
            at, sizes = known.rows(word)
            each = np.add.reduceat((table @ head.astype(np.float32))[known.buckets[at]] * known.shares[at], np.cumsum(sizes) - sizes)
            starts = np.cumsum(counts) - counts
            worst = _worst(np.add.reduceat(each.astype(float)[of], starts) / counts, held)
            count = counts[worst]
            at, sizes = known.rows(word[of[_ranges(starts[worst], count)]])
            share = known.shares[at] / np.repeat(np.repeat(count, count), sizes)
            rows = np.add.reduceat(sizes, np.cumsum(count) - count)
            dense = np.add.reduceat(table[known.buckets[at]] * share[:, None], np.cumsum(rows) - rows, axis=0)
            chance = 1 / (1 + np.exp(-np.clip(dense @ head + bias, -30, 30)))
            error = (chance - labels[docs]) * weights[docs]
            used, inverse = np.unique(known.buckets[at], return_inverse=True)
            slope = np.bincount(inverse, share * np.repeat(error, rows))
            norm = float(head @ head)
            head_slope, bias_slope = dense.T @ error, error.sum()
            past[used] += slope**2 * norm
            table[used] -= ((rate * slope / np.sqrt(past[used]))[:, None] * head[None, :]).astype(np.float32)
            head_past += head_slope**2
            head -= rate * head_slope / np.sqrt(head_past)
            bias_past += bias_slope**2
            bias -= rate * bias_slope / np.sqrt(bias_past)
    return (table @ head).astype(np.float32), float(bias)


def passage_scores(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean of what each passage's words add, and the n + 1 passage offsets of the texts."""
    inverse, firsts, buckets, owners, shares, _ = _distinct_words(column)
    bounds, spans = _passages(firsts)
    if not len(inverse):
        return np.zeros(0), spans
    each = np.bincount(owners, table[buckets] * shares)[inverse]
    return np.add.reduceat(each, bounds[:-1]) / np.diff(bounds), spans


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Up to MOST_TOXIC and MOST_CLEAN labelled texts outside the held-out part, with the weight that restores each
    class's share among all labelled rows. Of repeated labels the largest counts, of repeated documents the smallest text."""
    known = (
        labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    toxic, clean = known.where("y = 1"), known.where("y = 0")
    totals = known.agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean"))
    picked = toxic.orderBy(*order).limit(MOST_TOXIC).union(clean.orderBy(*order).limit(MOST_CLEAN))
    share = F.when(F.col("y") == 1, F.greatest(F.lit(1.0), F.col("toxic") / MOST_TOXIC)).otherwise(F.greatest(F.lit(1.0), F.col("clean") / MOST_CLEAN))
    picked = picked.join(F.broadcast(totals)).select("doc_id", "y", share.alias("weight"))
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return (
        texts.join(F.broadcast(picked), "doc_id")  # at most MOST_TOXIC + MOST_CLEAN rows of three numbers
        .groupBy("doc_id", "y", "weight")
        .agg(F.min("text").alias("text"))
    )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, float]:
    """Train in one task on the bounded sample; the driver gets one number for each of BUCKETS buckets. Without both
    classes among the labels the model is empty and gives every text the share of toxic labels (0.1 if there is none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
        y, weight = rows["y"].to_numpy().astype(float), rows["weight"].to_numpy()
        if len(y) and 0 < y.sum() < len(y):
            table, bias = fit(rows["text"].combine_chunks(), y, weight / weight.mean())
        else:
            share = np.clip(y.mean(), 0.01, 0.99)
            table, bias = np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
        yield pa.RecordBatch.from_pylist([{"weights": table.tobytes(), "bias": bias}], pa.schema([("weights", pa.binary()), ("bias", pa.float64())]))

    rows = training_rows(docs, labels, id_col, text_col, label_col)
    typed = rows.select(F.col("doc_id").cast("long"), F.col("y").cast("long"), F.col("weight").cast("double"), "text")
    model = typed.coalesce(1).mapInArrow(run, "weights binary, bias double").first()
    if model is None:
        return np.zeros(BUCKETS, np.float32), float(np.log(0.1 / 0.9))
    return np.frombuffer(model["weights"], np.float32), model["bias"]


def _chances(piece: pa.RecordBatch, table: np.ndarray, bias: float) -> np.ndarray:
    means, spans = passage_scores(pc.utf8_lower(piece.column("text")), table)
    worst, full = np.zeros(piece.num_rows), np.flatnonzero(np.diff(spans))
    if len(full):
        worst[full] = np.maximum.reduceat(means, spans[full])
    return 1 / (1 + np.exp(-np.clip(worst + bias, -50, 50)))


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1, higher: toxic likelier) and predicted (score of 0.5 or more) of every row. All
    passages of the whole text are read. A null or empty text has the score of the bias alone. Equal texts score alike; nulls and
    repeats in the id are kept. Only the two named columns are read."""
    table, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(_chances(piece, shared.value, bias))], ["doc_id", "score"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """The rows of docs that the model does not predict toxic, in one pass and with all their columns."""
    table, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                named = pa.RecordBatch.from_arrays([piece.column(text_col)], ["text"])
                yield piece.filter(pa.array(_chances(named, shared.value, bias) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
