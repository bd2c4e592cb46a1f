"""Document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once; the high bits choose one of BINS bins, the smallest rest stays. An empty bin takes
the value of the first filled bin on its own random walk over all bins, the same walk in every text (optimal
densification), so texts of any length fill all bins. Of each value the low BITS bits are packed; two fingerprints agree
in a bin by chance once in 2**BITS, which the likeness corrects for.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.hashing import mix, shingles, text_bytes, unpacked, word_hashes

BINS = 512
BITS = 4
SHINGLE = 5
_FIRST_STEPS = 32
_SALTS = mix(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


@lru_cache(maxsize=1)
def _walks() -> tuple[np.ndarray, np.ndarray]:
    """Each bin's walk over all bins, and the step at which a walk reaches a bin."""
    walk = np.random.default_rng(77).random((BINS, BINS)).argsort(axis=1).astype(np.int16)
    step = np.empty_like(walk)
    np.put_along_axis(step, walk.astype(np.int64), np.arange(BINS, dtype=np.int16)[None, :], axis=1)
    return walk, step


def bin_values(hashes: np.ndarray) -> np.ndarray:
    """The low bits of all bins of a text with at least one shingle."""
    walk, step = _walks()
    ordered = np.sort(mix(hashes))
    place = (ordered >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    filled = place[first]
    values = np.zeros(BINS, np.uint64)
    values[filled] = ordered[first]
    if len(filled) < BINS:
        has = np.zeros(BINS, bool)
        has[filled] = True
        empty = np.flatnonzero(~has)
        near = has[walk[empty, :_FIRST_STEPS]]
        taken = walk[empty, near.argmax(axis=1)].astype(np.int64)
        late = ~near.any(axis=1)
        taken[late] = filled[step[empty[late]][:, filled].argmin(axis=1)]
        values[empty] = values[taken]
    # The bits kept are those of a new hash in every bin: where a few values fill all bins, two texts must not agree by
    # chance in all of them at once.
    return (mix(values ^ _SALTS) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def fingerprints(column: pa.Array) -> list[np.ndarray | None]:
    """Bin values of each text, None for a text without words."""
    hashes, ends = shingles(*word_hashes(*text_bytes(column)), SHINGLE)
    return [bin_values(hashes[a:b]) if b > a else None for a, b in zip(ends[:-1], ends[1:], strict=True)]


def packed_text(values: np.ndarray | None) -> str:
    """Bin values as text: BITS bits each in base64; the empty string for a text without words."""
    if values is None:
        return ""
    return base64.b64encode((values[0::2] << BITS | values[1::2]).tobytes()).decode()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated share of common shingles: 1 for two texts without words, 0 if only one has none."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 1 / (1 << BITS)
    return float(np.clip((np.mean(a == b) - chance) / (1 - chance), 0, 1))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in descending id order, dealt out in ranges of ids: each range is followed by the first row of the next one
    (the last range by the very first row), marked `tail`. Columns: part, tail, doc_id, null_id, digest, packed.

    The ranges are quantiles of the ids, at most a few for each shuffle partition; only their bounds and first ids come
    to the driver. Texts are packed and shuffled once.
    """
    spark = docs.sparkSession
    smallest = -(2**63)
    rows = docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(smallest)).alias("doc_id"),
        docs[id_col].isNull().alias("null_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))
    keyed = rows.select("*", F.xxhash64("text").alias("digest"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(bounds, batch.column("doc_id").to_numpy(), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(part), batch.column("doc_id"), batch.column("digest")], ["part", "doc_id", "digest"])

    tops = keyed.select("doc_id", "digest").mapInArrow(numbered, "part long, doc_id long, digest long")
    heads = sorted((r["part"], r["top"]["doc_id"], r["top"]["digest"]) for r in tops.groupBy("part").agg(F.max(F.struct("doc_id", "digest")).alias("top")).collect())
    # The row that heads a range also ends the range above it; the highest head ends the lowest range.
    ends = {(doc, digest): heads[(at + 1) % len(heads)][0] for at, (_, doc, digest) in enumerate(heads)}
    head_ids = np.array(sorted({doc for doc, _ in ends}), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            part = np.searchsorted(bounds, ids, side="left")
            packed = [pack(value.encode()) for value in batch.column("text").to_pylist()]
            digest = batch.column("digest").to_pylist()
            twice = [row for row in np.flatnonzero(np.isin(ids, head_ids)).tolist() if (int(ids[row]), digest[row]) in ends]
            rows = np.array([*range(len(ids)), *twice], np.int64)
            to = np.concatenate([part, np.array([ends[int(ids[row]), digest[row]] for row in twice], np.int64)])
            columns = [pa.array(to), pa.array(np.arange(len(rows)) >= len(ids)), *(batch.column(c).take(pa.array(rows)) for c in ("doc_id", "null_id", "digest"))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary()).take(pa.array(rows))], ["part", "tail", "doc_id", "null_id", "digest", "packed"])

    dealt = keyed.mapInArrow(deal, "part long, tail boolean, doc_id long, null_id boolean, digest long, packed binary")
    order = ["part", "tail", F.desc("doc_id"), F.desc("digest")]
    return dealt.repartition(parts, "part").sortWithinPartitions(*order)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, in which the last floor(n / 2) characters have given way to
    as many first ones (or all) of the next document in descending id order, after the last one the first.

    One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A
    null text is an empty one; a text without words has the fingerprint '' and is like nothing but its kind. A null id
    comes last. Rows of one id follow by text hash; equal rows follow one another. A single document follows itself.
    An empty table gives an empty result. Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int | None, str]] = []  # part, id, text of rows whose next row is still to come
        ended = -1

        def results(rows: list[tuple[int, int | None, str]], following: list[str]) -> pa.RecordBatch:
            texts = [text for *_, text in rows]
            edited = [text[: len(text) - len(text) // 2] + after[: len(text) // 2] for text, after in zip(texts, following, strict=True)]
            own, changed, later = (fingerprints(pa.array(column, pa.large_string())) for column in (texts, edited, following[-1:]))
            after = [*own[1:], *later]
            for at in range(len(rows) - 1):
                if following[at] is not texts[at + 1]:  # the row before a new range is followed by that range's copy
                    after[at] = fingerprints(pa.array([following[at]], pa.large_string()))[0]
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(),
                        "fingerprint": packed_text(mark), "edited_fingerprint": packed_text(other),
                        "near_edited": likeness(mark, other), "near_next": likeness(mark, then),
                    }
                    for (_, doc, text), new, mark, other, then in zip(rows, edited, own, changed, after, strict=True)
                ],
                schema,
            )

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                piece = batch.slice(begin, 256)
                ready: list[tuple[int, int | None, str]] = []
                following: list[str] = []
                ids = [None if null else doc for doc, null in zip(piece.column("doc_id").to_pylist(), piece.column("null_id").to_pylist(), strict=True)]
                texts = unpacked(piece.column("packed")).to_pylist()
                for part, tail, doc, text in zip(piece.column("part").to_pylist(), piece.column("tail").to_pylist(), ids, texts, strict=True):
                    if tail and part == ended:
                        continue
                    if held:
                        ready.append(held.pop())
                        following.append(text)
                    if tail:
                        ended = part
                    else:
                        held.append((part, doc, text))
                for at in range(0, len(ready), 64):
                    yield results(ready[at : at + 64], following[at : at + 64])

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
        + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, id_col, text_col).mapInArrow(run, kinds)
