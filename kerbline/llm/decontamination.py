"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of PASSAGE words, STRIDE apart. Terms are the words of the benchmark items (lower case, without
ASCII punctuation). All passages of the corpus and the items' own are the rows of a TF-IDF matrix; those without a weighted
term are rows of zeros. Its randomised SVD (a range finder and Gram products, summed over tasks) gives the latent space in
which passages and items meet. Every passage is held against every passage of an item: one at least MIN_COSINE like it is a
candidate. Candidates are then checked exactly. A window, a passage with half an item's words on both sides, that has `least`
of n words has at least k of any n - least + k of them: it is counted whether it has enough of the item's rarest words. Where
it has, the longest common subsequence of the item's words and those of the window decides, and below LEAST_SHARE, for a
paraphrase, whether the item's answer (its last sentence) is there as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from kerbline.llm.hashing import slices, text_bytes, word_hashes
from kerbline.llm.stage import store

PASSAGE = 32
STRIDE = 16
#: How many of an item's rarest words a window must have to be aligned: the more, the commoner these words are.
ANCHORS = 4
LEAST_SHARE = 0.7
PARAPHRASE_SHARE = 0.5
ANSWER_WORDS = 3
#: Dimensions of the latent space, and columns of the random start beyond them.
RANK = 128
OVERSAMPLING = 16
#: Terms in more than this share of all passages are stop words and have no weight, unless fewer than LEAST_TERMS
#: would be left of an item.
MOST_SHARE = 0.02
LEAST_TERMS = 4
#: A passage and one of an item less alike than this are no candidates. For an item's passage of fewer than PASSAGE words,
#: which other words drown, it falls with the root of its share.
MIN_COSINE = 0.12
#: Items are searched for in blocks of about so many bytes of text; a block's terms and vectors are broadcast: some 100,000
#: terms of RANK numbers, 50 MB.
BLOCK_BYTES = 1 << 22
CHUNK_TERMS = 256
SLICE_BYTES = 1 << 19
#: Words of stored texts that are handled at once, and cosines.
SLICE_WORDS = 1 << 17
TILE = 1 << 21
#: Ranges of more rows than these are added up one by one.
WIDE = 64


def _plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_bytes(pc.utf8_lower(column)), plain=True)


@dataclass
class Items:
    """A block of benchmark items: their words as term numbers, the sorted hashes of all terms, and the answers' terms."""

    ids: list[int]
    terms: np.ndarray
    sequences: list[np.ndarray]
    answers: list[np.ndarray]

    @staticmethod
    def of(ids: list[int], texts: list[str]) -> Items:
        hashes, ends = _plain_words(pa.array(texts, pa.string()))
        terms = np.unique(hashes)
        last = [next((s for s in reversed(re.split(r"[.!?\n]+", text)) if s.strip()), "") for text in texts]
        answers, answer_ends = _plain_words(pa.array(last, pa.string()))
        cut = lambda values, at: [np.searchsorted(terms, values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        return Items(ids, terms, cut(hashes, ends), cut(answers, answer_ends))


def _term_numbers(column: pa.Array, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The term number of each word, len(terms) for a word of no item, and the word offsets of the texts."""
    hashes, ends = _plain_words(column)
    at = np.searchsorted(terms, hashes)
    known = terms[np.minimum(at, len(terms) - 1)] == hashes
    return np.where(known, at, len(terms)), ends


def passages(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 word of every passage; the last passage of a text ends with it."""
    counts = np.diff(ends)
    many = np.where(counts > PASSAGE, -(-(counts - PASSAGE) // STRIDE) + 1, (counts > 0).astype(counts.dtype))
    text = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    first = ends[text] + nth * STRIDE
    return first, np.minimum(first + PASSAGE, ends[text + 1])


def _pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, text, SLICE_BYTES)


def numbered(rows: DataFrame, items: Items, text: str = "text") -> DataFrame:
    """The rows with `terms`: the term number of each word of the text (_term_numbers) as 32-bit integers."""
    shared = rows.sparkSession.sparkContext.broadcast(items.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, text):
            numbers, ends = _term_numbers(piece.column(text), shared.value)
            packed = [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(numbers.astype(np.int32))]
            terms = pa.Array.from_buffers(pa.binary(), piece.num_rows, packed)
            yield pa.RecordBatch.from_arrays([*piece.columns, terms], [*piece.schema.names, "terms"])

    return rows.mapInArrow(run, StructType([*rows.schema, StructField("terms", BinaryType())]))


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The term numbers of the texts, and their n + 1 word offsets."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return held.view(np.int32).astype(np.int64), (ends - ends[0]) // 4


def _stored_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "terms", 4 * SLICE_WORDS)


def passage_counts(stored: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many passages of the corpus each of `size` terms is, and the number of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(size + 1, np.int64), 0
        for piece in _stored_pieces(batches):
            numbers, ends = _unpacked(piece.column("terms"))
            first, last = passages(ends)
            known = np.flatnonzero(numbers < size)
            low, high = np.searchsorted(known, first), np.searchsorted(known, last)
            which, at = _expanded(low, high)
            each = np.unique(which * (size + 1) + numbers[known[at]])
            found += np.bincount(each % (size + 1), minlength=size + 1)
            total += len(first)
        found[-1] = total
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["term", "n"])

    counted = stored.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size + 1, np.int64)
    out[counted["term"]] = counted["n"]
    return out[:-1], int(out[-1])


@dataclass
class Lookup:
    """For each term the items that look it up (`starts` are the terms' bounds in `owners`); `needed` is how many looked-up
    words a window must have for each item, `copied` how many words in order make it a copy; `parts` are the words of each
    item and its answer (_parts), `repeats` how many words of an item are there again."""

    items: Items
    starts: np.ndarray
    owners: np.ndarray
    needed: np.ndarray
    copied: np.ndarray
    parts: list[list[tuple[np.ndarray, np.ndarray, np.uint64, np.uint64]]]
    repeats: np.ndarray


@dataclass
class Model:
    """A lookup, the vector of each term in the latent space, and per item the unit vectors of its passages there (`bounds`
    are the items' bounds) with the cosine that makes a candidate."""

    lookup: Lookup
    vectors: np.ndarray
    queries: np.ndarray
    bounds: np.ndarray
    least: np.ndarray


def least_copied(item: np.ndarray) -> int:
    """The smallest number of common words that make a copy."""
    return max(1, int(np.ceil((LEAST_SHARE if len(item) >= 5 else 1.0) * len(item) - 1e-9)))


def least_words(item: np.ndarray, answer: np.ndarray) -> int:
    """The smallest number of common words with which matches() may accept."""
    if len(answer) >= ANSWER_WORDS and len(item) >= 2 * len(answer):
        return max(1, int(np.ceil(PARAPHRASE_SHARE * len(item) - 1e-9)))
    return least_copied(item)


def look_up(items: Items, counts: np.ndarray) -> Lookup:
    """For each item its rarest words in the corpus, so many that any match has `needed` of them."""
    terms, owners, needed = [], [], []
    for owner, (item, answer) in enumerate(zip(items.sequences, items.answers, strict=True)):
        least = least_words(item, answer)
        needed.append(min(ANCHORS, least))
        own, times = np.unique(item, return_counts=True)
        order = np.lexsort((own, counts[own]))
        taken = order[: 1 + int(np.searchsorted(np.cumsum(times[order]), len(item) - least + needed[-1]))]
        terms.append(own[taken])
        owners.append(np.full(len(taken), owner))
    every = np.concatenate(terms)
    order = np.argsort(every, kind="stable")
    starts = np.searchsorted(every[order], np.arange(len(items.terms) + 2))
    copied = np.array([least_copied(item) for item in items.sequences])
    parts = [_parts(item, answer) for item, answer in zip(items.sequences, items.answers, strict=True)]
    repeats = np.array([len(item) - len(set(item.tolist())) for item in items.sequences])
    return Lookup(items, starts, np.concatenate(owners)[order], np.array(needed), copied, parts, repeats)


def term_weights(items: Items, counts: np.ndarray, total: int) -> np.ndarray:
    """Inverse passage frequencies; 0 for stop words."""
    idf = np.log((1 + total) / (1 + counts)) + 1e-3
    stop = counts > MOST_SHARE * total
    for sequence in items.sequences:
        if len(set(sequence[~stop[sequence]].tolist())) < LEAST_TERMS:
            stop[sequence] = False
    return np.where(stop, 0, idf)


def _range_sums(values: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sum of the rows of `values` that each range low..high-1 of `rows` names; the n-th rows of all ranges at a time."""
    width = np.maximum(high - low, 0)
    order = np.argsort(-width, kind="stable")
    many, begin = width[order], low[order]
    out = np.zeros((len(low), values.shape[1]), values.dtype)
    for nth in range(min(WIDE, int(many[0])) if len(many) else 0):
        some = int(np.searchsorted(-many, -nth))
        out[:some] += values[rows[begin[:some] + nth]]
    for one in range(int(np.searchsorted(-many, -WIDE))):
        out[one] += values[rows[begin[one] + WIDE : begin[one] + many[one]]].sum(axis=0)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def _sums(vectors: np.ndarray, numbers: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum of the vectors of the terms in each range of words; words of no term or without weight add nothing."""
    known = np.flatnonzero(np.append(vectors.any(axis=1), False)[numbers])
    return _range_sums(vectors, numbers[known], np.searchsorted(known, first), np.searchsorted(known, last))


def _strides(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last + 1 word of every stride; the first stride of every passage, and which passages have a second one."""
    many = -(-np.diff(ends) // STRIDE)
    text = np.repeat(np.arange(len(many)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    first = ends[text] + nth * STRIDE
    lead = np.flatnonzero((nth < many[text] - 1) | (many[text] == 1))
    return first, np.minimum(first + STRIDE, ends[text + 1]), lead, np.flatnonzero(many[text[lead]] > 1)


def _images(vectors: np.ndarray, numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the vectors of each passage of the texts, from those of its two strides."""
    first, last, lead, two = _strides(ends)
    each = _sums(vectors, numbers, first, last)
    out = each[lead]
    out[two] += each[lead[two] + 1]
    return out


def _scatter(out: np.ndarray, numbers: np.ndarray, ends: np.ndarray, image: np.ndarray, weighted: np.ndarray) -> None:
    """Transposed product: to the row of each term that has a weight, add the sum of the images of the texts' passages it is
    in, as often as it is there."""
    first, last, lead, two = _strides(ends)
    each = np.zeros((len(first), image.shape[1]), image.dtype)
    each[lead] = image
    each[lead[two] + 1] += image[two]
    known = np.flatnonzero(np.append(weighted, False)[numbers])
    stride = np.searchsorted(first, known, side="right") - 1
    order = np.argsort(numbers[known], kind="stable")
    value, start = np.unique(numbers[known][order], return_index=True)
    out[value] += _range_sums(each, stride[order], start, np.append(start[1:], len(order)))


def _summed(stored: DataFrame, shared, add, rows: int, width: int) -> np.ndarray:
    """Sum over the passages of all stored texts of a matrix to which `add` adds that of some texts and their passages' images:
    each task adds its own up, Spark adds up the tasks' in chunks of rows, and only the sum comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((rows, width))
        for piece in _stored_pieces(batches):
            numbers, ends = _unpacked(piece.column("terms"))
            add(out, numbers, ends, _images(shared.value, numbers, ends))
        starts = range(0, rows, CHUNK_TERMS)
        parts = [out[a : a + CHUNK_TERMS].tobytes() for a in starts]
        yield pa.RecordBatch.from_arrays([pa.array(list(starts), pa.int64()), pa.array(parts, pa.binary())], ["chunk", "part"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        summed = sum(np.frombuffer(part) for part in frame["part"])
        return pd.DataFrame({"chunk": frame["chunk"][:1], "part": [summed.tobytes()]})

    chunks = stored.select("terms").mapInArrow(run, "chunk long, part binary").groupBy("chunk").applyInPandas(total, "chunk long, part binary").collect()
    if not chunks:
        return np.zeros((rows, width))
    return np.frombuffer(bytearray(b"".join(row["part"] for row in sorted(chunks, key=lambda row: row["chunk"])))).reshape(rows, width)


def latent_vectors(stored: DataFrame, queries: tuple[np.ndarray, np.ndarray], idf: np.ndarray, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Vector of each term: its weight times its row of the leading right singular vectors of the TF-IDF matrix, whose rows
    are the passages of the stored texts and of `queries`, the items.

    Range finder: the product of A'A with a random block, made orthogonal. Then the Gram matrix of all passages' images
    in that range, whose eigenvectors turn it to the singular directions.
    """
    context = stored.sparkSession.sparkContext
    size, columns = len(idf), min(rank + OVERSAMPLING, len(idf))
    numbers, ends = queries
    weighted = idf > 0
    start = (np.random.default_rng(seed).normal(size=(size, columns)) * idf[:, None]).astype(np.float32)
    product = _summed(stored, context.broadcast(start), lambda out, n, e, image: _scatter(out, n, e, image, weighted), size, columns)
    _scatter(product, numbers, ends, _images(start, numbers, ends), weighted)
    basis, _ = np.linalg.qr(product * idf[:, None])
    ranged = (basis * idf[:, None]).astype(np.float32)
    gram = _summed(stored, context.broadcast(ranged), lambda out, n, e, image: np.add(out, image.T @ image, out=out), columns, columns)
    own = _images(ranged, numbers, ends).astype(float)
    _, turn = np.linalg.eigh(gram + own.T @ own)
    return (ranged @ turn[:, ::-1][:, :rank]).astype(np.float32)


def _unit(images: np.ndarray) -> np.ndarray:
    return images / np.maximum(np.linalg.norm(images, axis=1, keepdims=True), 1e-12)


def fit(stored: DataFrame, items: Items) -> Model:
    """Counts over all passages of the stored texts (`terms` of numbered()), then their latent space."""
    counts, total = passage_counts(stored, len(items.terms))
    lookup, idf = look_up(items, counts), term_weights(items, counts, total)
    sizes = np.array([len(s) for s in items.sequences])
    flat, ends = np.concatenate(items.sequences), np.concatenate([[0], np.cumsum(sizes)])
    vectors = latent_vectors(stored, (flat, ends), idf)
    first, last = passages(ends)
    bounds = np.searchsorted(first, ends)
    least = MIN_COSINE * np.sqrt(np.minimum(1, (last - first) / PASSAGE))
    return Model(lookup, vectors, _unit(_images(vectors, flat, ends)), bounds, least.astype(np.float32))


def common_words(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    places: dict[int, int] = {}
    for at, value in enumerate(item.tolist()):
        places[value] = places.get(value, 0) | 1 << at
    row = every = (1 << len(item)) - 1
    for value in text.tolist():
        hit = row & places.get(value, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & every
    return len(item) - row.bit_count()


def matches(item: np.ndarray, answer: np.ndarray, text: np.ndarray) -> float:
    """Share of the item's words that the text has in order, or 0 if that does not make it a copy or a paraphrase."""
    share = common_words(item, text) / len(item)
    if share >= LEAST_SHARE and (len(item) >= 5 or share == 1):
        return share
    if share >= PARAPHRASE_SHARE and len(answer) >= ANSWER_WORDS and len(item) >= 2 * len(answer):
        return share if common_words(answer, text) == len(answer) else 0.0
    return 0.0


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range and value of every integer in the ranges low..high-1."""
    width = np.maximum(high - low, 0)
    return np.repeat(np.arange(len(low)), width), np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())


def candidates(numbers: np.ndarray, ends: np.ndarray, model: Model) -> Iterator[tuple[int, np.ndarray]]:
    """Every passage of the texts against every passage of an item: tiles of passages, with the number of the first one, and
    whether each is near enough in the latent space to each of the items' passages."""
    images = _unit(_images(model.vectors, numbers, ends))
    size = max(1, TILE // max(1, len(model.queries)))
    for begin in range(0, len(images), size):
        yield begin, images[begin : begin + size] @ model.queries.T >= model.least


def _looked_up(numbers: np.ndarray, lookup: Lookup) -> np.ndarray:
    """Where the words are that an item looks up, in order: item * (len(numbers) + 1) + word."""
    known = np.flatnonzero(np.diff(lookup.starts)[numbers])
    which, at = _expanded(lookup.starts[numbers[known]], lookup.starts[numbers[known] + 1])
    return np.sort(lookup.owners[at] * (len(numbers) + 1) + known[which])


def _possible(numbers: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray, model: Model) -> np.ndarray:
    """The candidates, as pairs of an item and a passage in order, less those whose window has too few looked-up words."""
    lookup, size = model.lookup, len(numbers) + 1
    places = np.concatenate([[-1], _looked_up(numbers, lookup), np.full(ANCHORS, np.iinfo(np.int64).max)])
    around = np.array([len(sequence) // 2 for sequence in lookup.items.sequences])
    row = np.searchsorted(ends, first, side="right") - 1
    begin, end = ends[row], ends[row + 1]
    owners = np.repeat(np.arange(len(around)), np.diff(model.bounds))
    out = [np.zeros(0, np.int64)]
    for start, near in candidates(numbers, ends, model):
        query, at = np.nonzero(np.ascontiguousarray(near.T))
        item, at = owners[query], at + start
        base, beyond = item * size, around[item]
        nth = np.searchsorted(places, base + np.maximum(begin[at], first[at] - beyond)) + lookup.needed[item] - 1
        enough = places[nth] < base + np.minimum(end[at], last[at] + beyond)
        out.append(item[enough] * size + at[enough])
    pairs = np.unique(np.concatenate(out))
    return np.stack([pairs // size, pairs % size], axis=1)


def _parts(item: np.ndarray, answer: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.uint64, np.uint64]]:
    """The different words of an item and its answer, 64 at a time: the words, a bit for each, the item's bits, the answer's."""
    words, out = np.union1d(item, answer), []
    for some in range(0, len(words), 64):
        part = words[some : some + 64]
        bits = np.uint64(1) << np.arange(len(part), dtype=np.uint64)
        out.append((part, bits, *(np.bitwise_or.reduce(bits[np.isin(part, one)], initial=np.uint64(0)) for one in (item, answer))))
    return out


def _held(item: int, lookup: Lookup, padded: np.ndarray, begin: np.ndarray, end: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether each window begin..end-1 has enough different words of the item for a copy, or all words of its answer; of
    `padded` the last word is of no term, and `places` are zeros, as they are left."""
    at = begin[:, None] + np.arange(int((end - begin).max()))
    text = padded[np.where(at < end[:, None], at, len(padded) - 1)]
    common, told = np.full(len(begin), lookup.repeats[item]), np.ones(len(begin), bool)
    for part, bits, of_item, of_answer in lookup.parts[item]:
        places[part] = bits
        found = np.bitwise_or.reduce(places[text], axis=1)
        places[part] = 0
        common += np.bitwise_count(found & of_item)
        told &= found & of_answer == of_answer
    return (common >= lookup.copied[item]) | told


def _found(numbers: np.ndarray, ends: np.ndarray, model: Model) -> dict[int, dict[int, float]]:
    """For each text of a slice the items in it and their shares."""
    lookup, items = model.lookup, model.lookup.items
    first, last = passages(ends)
    pairs = _possible(numbers, ends, first, last, model)
    rows = np.searchsorted(ends, first[pairs[:, 1]], side="right") - 1
    around = np.array([len(sequence) // 2 for sequence in items.sequences])[pairs[:, 0]]
    begin, end = np.maximum(ends[rows], first[pairs[:, 1]] - around), np.minimum(ends[rows + 1], last[pairs[:, 1]] + around)
    out: dict[int, dict[int, float]] = {}
    bounds = np.append(np.flatnonzero(np.diff(pairs[:, 0], prepend=-1)), len(pairs)).tolist()
    padded, places = np.append(numbers, len(items.terms)), np.zeros(len(items.terms) + 1, np.uint64)
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        item = int(pairs[low, 0])
        sequence, answer = items.sequences[item], items.answers[item]
        held = _held(item, lookup, padded, begin[low:high], end[low:high], places)
        for at in (low + np.flatnonzero(held)).tolist():
            known = out.get(int(rows[at]), {})
            if known.get(item, 0) >= LEAST_SHARE:
                continue
            if share := matches(sequence, answer, numbers[begin[at] : end[at]]):
                out.setdefault(int(rows[at]), known)[item] = max(share, known.get(item, 0))
    return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[Items, bool]]:
    """The items in blocks of bounded size, by hash of their id, and whether others may follow. Items without words are left
    out: nothing can hold them."""
    rows = benchmark.select(benchmark[id_col].cast("long").alias("item_id"), F.coalesce(benchmark[text_col], F.lit("")).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        held = [(row["item_id"], row["text"]) for row in own if re.search(r"\w", row["text"])]
        if held:
            yield Items.of([one for one, _ in held], [text for _, text in held]), block + 1 < blocks


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, items (sorted ids of the benchmark items in the text), share (largest part of an item that is there, in
    order; 0 if none) and contaminated, for every row.

    A null or empty text holds nothing. Null ids and repeated rows are kept. Without items nothing is contaminated. Only
    the named columns are read. Items are taken from the whole text.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    out = rows.withColumn("items", F.expr("cast(array() as array<bigint>)")).withColumn("share", F.lit(0.0))
    for items, more in item_blocks(benchmark):
        terms = numbered(out, items)
        stored = store(terms.drop("text"))
        held = terms if more else stored
        names = [name for name in held.columns if name != "terms"]
        shared = rows.sparkSession.sparkContext.broadcast(fit(stored, items))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, names=names) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for piece in _stored_pieces(batches):
                found = _found(*_unpacked(piece.column("terms")), model)
                lists, shares = piece.column("items").to_pylist(), piece.column("share").to_pylist()
                for row, known in found.items():
                    lists[row] = sorted({*lists[row], *(model.lookup.items.ids[item] for item in known)})
                    shares[row] = max(shares[row], *known.values())
                made = {"items": pa.array(lists, pa.list_(pa.int64())), "share": pa.array(shares, pa.float64())}
                yield pa.RecordBatch.from_arrays([made.get(name, piece.column(name)) for name in names], names)

        out = held.mapInArrow(run, held.drop("terms").schema)
    return out.select("doc_id", "items", "share", (F.size("items") > 0).alias("contaminated"))


def without_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns; one pass for each block of items."""
    out = docs
    texts = docs.select(docs[text_col].alias("text"))
    for items, _ in item_blocks(benchmark):
        stored = store(numbered(texts, items).drop("text"))
        shared = docs.sparkSession.sparkContext.broadcast(fit(stored, items))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for piece in _pieces(batches, text_col):
                clean = np.ones(piece.num_rows, bool)
                clean[list(_found(*_term_numbers(piece.column(text_col), model.lookup.items.terms), model))] = False
                yield piece.filter(pa.array(clean))

        out = out.mapInArrow(keep, docs.schema)
    return out
