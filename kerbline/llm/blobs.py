"""Integer and float arrays as one compressed bytes value, and streams of such values grouped by key."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in the smallest unsigned type that holds them (floats as they are), bytes of equal weight together, so
    that what is small or sorted compresses."""
    parts = []
    for array in arrays:
        array = np.ascontiguousarray(array)
        if array.dtype.kind != "f":
            most = int(array.max()) if len(array) else 0
            array = array.astype(next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(kind).max))
        parts.append(struct.pack("<cBQ", array.dtype.kind.encode(), array.itemsize, len(array)))
        parts.append(array.view(np.uint8).reshape(len(array), array.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        kind, width, count = struct.unpack_from("<cBQ", data, at)
        raw = np.frombuffer(data, np.uint8, width * count, at + 10).reshape(width, count).T
        array = np.ascontiguousarray(raw).view(np.dtype(f"{kind.decode()}{width}")).ravel()
        out.append(array if kind == b"f" or width == 8 else array.astype(np.int64))
        at += 10 + width * count
    return out


def sorted_pack(values: np.ndarray) -> np.ndarray:
    """Differences of sorted unsigned values, for pack(); np.cumsum(..., dtype=np.uint64) brings them back."""
    values = values.astype(np.uint64)
    return np.diff(values, prepend=np.uint64(0))


def rows_by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches, grouped by key; only one batch is held."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield {name: batch.column(name)[at].as_py() for name in batch.schema.names}

    return groupby(rows(), key=lambda row: tuple(row[name] for name in keys))
