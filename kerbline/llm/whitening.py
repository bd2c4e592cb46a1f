"""Whitened leading components of an embedding table, on integer coordinates.

An entry c becomes x = floor(1024 * c) + 100000. Sums per dimension are exact. The covariance is summed over tasks from
centred rows; its leading eigenpairs (see symmetric) are a few vectors, which go to the tasks that project all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.stage import store
from kerbline.llm.symmetric import leading_pairs

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries of this size and more count as not finite: their x would not be exact.
TOO_LARGE = 2.0**38
BLOCK_ENTRIES = 1 << 20
SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"

Moments = tuple[int, np.ndarray, np.ndarray]


def usable(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector of the rows whose vector is there and has finite entries only."""
    rows = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), embeddings[vector_col].cast("array<double>").alias("vector"))
    return rows.where(F.col("vector").isNotNull() & F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < TOO_LARGE)))


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and x of the vectors of one length, in blocks of bounded size."""
    vectors = batch.column("vector")
    lengths = pc.list_value_length(vectors)
    kept = batch.filter(pc.equal(lengths, size))
    step = max(1, BLOCK_ENTRIES // max(size, 1))
    for at in range(0, kept.num_rows, step):
        part = kept.slice(at, step)
        flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
        yield part.column("vec_id"), (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(part.num_rows, size)


def _totals(rows: DataFrame) -> tuple[int, int, list[int]]:
    """The commonest vector length (of equally common ones the longest), the number of such vectors and their sums.

    A task gives one row for each length and dimension, which Spark adds up; what is collected is one row per dimension.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for size in pc.unique(pc.list_value_length(batch.column("vector"))).to_pylist():
                for ids, x in _blocks(batch, size):
                    n, total = sums.get(size, (0, [0] * size))
                    sums[size] = n + len(ids), [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        for size, (n, total) in sums.items():
            yield pa.RecordBatch.from_pydict({
                "size": pa.array([size] * (size + 1), pa.int32()),
                "dimension": pa.array(range(-1, size), pa.int32()),
                "total": pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0)),
            })

    partial = rows.mapInArrow(add, "size int, dimension int, total decimal(38,0)")
    totals = store(partial.groupBy("size", "dimension").agg(F.sum("total").cast("decimal(38,0)").alias("total")))
    common = totals.where("dimension = -1").orderBy(F.desc("total"), F.desc("size")).first()
    if common is None:
        return 0, 0, []
    sums = totals.where((F.col("size") == common["size"]) & (F.col("dimension") >= 0)).orderBy("dimension").collect()
    return common["size"], int(common["total"]), [int(row.total) for row in sums]


def _joined(a: Moments, b: Moments) -> Moments:
    """Count, mean and centred product sums of two disjoint sets of rows taken together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _covariance(rows: DataFrame, size: int, of: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Covariance, with divisor n, of `of` numbers that `values` makes of each row. Every block is centred before it is
    multiplied; tasks give one matrix each, which are joined in two steps, in the order of the tasks."""
    none = (0, np.zeros(of), np.zeros((of, of)))

    def row(part: int, moments: Moments) -> pa.RecordBatch:
        n, mean, products = moments
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int64()), "n": pa.array([n], pa.int64()),
            "mean": pa.array([mean.tobytes()]), "products": pa.array([products.tobytes()]),
        })

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = none
        for batch in batches:
            for _, x in _blocks(batch, size):
                z = values(x)
                mean = z.mean(axis=0)
                z = z - mean
                held = _joined(held, (len(z), mean, z.T @ z))
        yield row(TaskContext.get().partitionId(), held)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = none, None
        for batch in batches:
            for one in batch.to_pylist():
                first = one["part"] if first is None else first
                held = _joined(held, (one["n"], np.frombuffer(one["mean"]), np.frombuffer(one["products"]).reshape(of, of)))
        if first is not None:
            yield row(first, held)

    schema = "part long, n long, mean binary, products binary"
    parts = rows.mapInArrow(measure, schema).repartition("part").sortWithinPartitions("part").mapInArrow(join, schema)
    whole = parts.repartition(1).sortWithinPartitions("part").mapInArrow(join, schema).collect()
    if not whole:
        return none[2]
    return np.frombuffer(whole[0].products).reshape(of, of) / max(whole[0].n, 1)


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and leading component: vec_id, component (from 1 by falling eigenvalue), n, deviation (exact sum
    over dimensions of (n * x - S)^2), whitened, explained, identity_error.

    A null vector, or one with a null, NaN, infinite or too large entry, gives no row. All vectors are to have one length:
    those of another than the commonest length are left out. Null and repeated ids are kept. No usable vector, or vectors
    without entries, give no rows. A component without variance (up to rounding) has a null in whitened and is left out of
    identity_error; explained is null where no dimension varies. A deviation of more than 38 digits is null. Only the two
    named columns are read.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings, id_col, vector_col)
    size, n, sums = _totals(rows)
    if not n or not size:
        return spark.createDataFrame([], SCHEMA)
    low = [total // n for total in sums]
    base, rest = np.array(low, np.int64), [total - n * m for total, m in zip(sums, low, strict=True)]
    share = np.array([r / n for r in rest])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base) - share

    covariance = _covariance(rows, size, size, centred)
    values, vectors = leading_pairs(covariance, components)
    trace = float(np.trace(covariance))
    varies = values > size * np.finfo(float).eps * values[0] if len(values) and values[0] > 0 else np.zeros(len(values), bool)
    projection = vectors[:, varies] / np.sqrt(values[varies])
    count = int(varies.sum())
    error = float(np.abs(_covariance(rows, size, count, lambda x: centred(x) @ projection) - np.eye(count)).max()) if count else None
    explained = [value / trace if trace > 0 else None for value in values.tolist()]

    def deviations(x: np.ndarray) -> pa.Array:
        y = x - base
        most = n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * size < 2**63:
            q = n * y - np.array(rest, np.int64)
            return pa.array((q * q).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = [sum((n * v - r) ** 2 for v, r in zip(one, rest, strict=True)) for one in y.tolist()]
        return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _blocks(batch, size):
                out = np.full((len(ids), len(values)), np.nan)
                out[:, varies] = centred(x) @ projection
                again = np.repeat(np.arange(len(ids)), len(values))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.take(pa.array(again)),
                    "component": pa.array(np.tile(np.arange(1, len(values) + 1, dtype=np.int32), len(ids))),
                    "n": pa.array(np.full(len(again), n)),
                    "deviation": deviations(x).take(pa.array(again)),
                    "whitened": pa.array(out.ravel(), mask=np.tile(~varies, len(ids))),
                    "explained": pa.array(explained * len(ids), pa.float64()),
                    "identity_error": pa.array([error] * len(again), pa.float64()),
                })

    return rows.mapInArrow(project, SCHEMA)
