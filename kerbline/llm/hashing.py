"""Texts as numpy arrays: bytes, words and shingles of a whole Arrow batch at a time, hashed without a Python loop.

A hash of a byte range is the difference of two prefix sums of (random value of the byte) x (odd base to the position),
brought back to position zero by the inverse power. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER_VALUES = _BYTE_VALUES.copy()
_LOWER_VALUES[65:91] = _BYTE_VALUES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IS_MARK = np.array([code < 128 and not chr(code).isalnum() for code in range(256)])
_powers: dict[int, np.ndarray] = {}


def power_table(base: int, size: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < size:
        table = np.full(max(size, 1 << 16), base, np.uint64)
        table[0] = 1
        _powers[base] = np.cumprod(table, dtype=np.uint64)
    return _powers[base][:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and the n + 1 offsets. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about max_bytes of text, so that the arrays made from one stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > max_bytes:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums that range_hash() takes differences of."""
    values = _LOWER_VALUES if lower else _BYTE_VALUES
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * power_table(BASE, len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes start..end of each range, independent of where the range lies."""
    inverse = power_table(pow(BASE, -1, 2**64), len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start])


def words(data: np.ndarray, offsets: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs without white space, or if `plain` without ASCII punctuation too, never over
    two texts), and each text's first word."""
    solid = ~(_IS_MARK if plain else _IS_SPACE)[data]
    before, after = np.zeros_like(solid), np.zeros_like(solid)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    return starts, np.flatnonzero(solid & ~after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value of each word and the n + 1 word offsets of the texts."""
    starts, ends, firsts = words(data, offsets, plain)
    return range_hash(prefix_hash(data, lower), starts, ends), firsts


def shingles(hashes: np.ndarray, firsts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Values of all runs of `size` words in text order, and the n + 1 offsets. A text of fewer words, but one at
    least, has one shingle of all its words."""
    counts = np.diff(firsts)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    ends = np.concatenate([[0], np.cumsum(made)])
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for step in range(size):
        total = mix(total * np.uint64(0x100000001B3) + padded[step : step + len(hashes)])
    keep = np.ones(len(hashes), bool)
    for back in range(1, size):
        at = firsts[1:] - back
        keep[at[at >= firsts[:-1]]] = False
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.zeros(1, np.uint64)
        for one in hashes[firsts[row] : firsts[row + 1]]:
            value = mix(value * np.uint64(0x100000001B3) + one)
        total[firsts[row]], keep[firsts[row]] = value[0], True
    return total[keep], ends


def packed_texts(rows: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text column by `packed`, its UTF-8 bytes under zstd: what is shuffled of it is less than half as much
    as under Spark's own codec, which sees rows in small blocks. A null is packed as an empty text."""
    others = [name for name in rows.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack((value or "").encode()) for value in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in others), pa.array(packed, pa.binary())], [*others, "packed"])

    kept = [field for field in rows.schema if field.name != text]
    return rows.select(*others, text).mapInArrow(run, StructType([*kept, StructField("packed", BinaryType())]))


def unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(value) for value in column.to_pylist()], pa.large_binary()).cast(pa.large_string())
