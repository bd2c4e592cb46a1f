"""Operator 12 against numpy's eigenvalues and Python's integers."""

import math
from collections import Counter

import numpy as np
import pytest

from kerbline.llm import registry, whitening
from kerbline.llm.symmetric import count_below, leading_pairs, tridiagonal
from kerbline.llm.whitening import whiten

SF = "/root/testdata/sf0.001"


def _plain(rows):
    """(vec_id, vector) pairs -> n, deviations, eigenvalues, covariance, centred rows, all by the plain formulas."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(one, sums, strict=True)) for one in x]
    z = np.array([[a - s / n for a, s in zip(one, sums, strict=True)] for one in x])
    return kept, n, deviations, z.T @ z / n, z


def _check(got, rows, components=8):
    kept, n, deviations, covariance, z = _plain(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, k + 1) for i, _ in kept for k in range(min(components, len(values))))
    assert {r.n for r in got} == {n}
    assert Counter((r.vec_id, int(r.deviation)) for r in got if r.component == 1) == Counter((i, d) for (i, _), d in zip(kept, deviations, strict=True))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(min(components, len(values))):
        found = {r.vec_id: r.whitened for r in got if r.component == k + 1}
        plain = {i: w for (i, _), w in zip(kept, z @ vectors[:, k] / math.sqrt(values[k]), strict=True)}
        sign = 1 if sum(found[i] * plain[i] for i in plain) > 0 else -1
        assert max(abs(found[i] - sign * plain[i]) for i in plain) < 1e-7
        assert {r.explained for r in got if r.component == k + 1}.pop() == pytest.approx(values[k] / np.trace(covariance), rel=1e-10)


def test_query_equals_the_plain_formulas(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _check(registry.queries()["op12_whitening"](spark, SF).collect(), rows)


def _frame(spark, rows, parts=3):
    rows = [(i, v, "clash", 1) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, n int").repartition(parts)


def test_rows_with_missing_or_infinite_entries_are_left_out(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=5).tolist()) for i in range(200)]
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [math.nan] * 5), (903, [math.inf, 0.0, 0.0, 0.0, 0.0]), (904, [0.0, 0.0, -math.inf, 0.0, 0.0])]
    _check(whiten(_frame(spark, rows + bad)).collect(), rows + bad)


def test_other_lengths_null_and_repeated_ids(spark):
    random = np.random.default_rng(2)
    rows = [(i % 7 if i % 7 else None, random.normal(size=3).tolist()) for i in range(40)]
    got = whiten(_frame(spark, rows + [(50, [1.0, 2.0]), (51, [])])).collect()
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, k) for i, _ in rows for k in (1, 2, 3))
    assert {r.n for r in got} == {40}


def test_no_variance_one_row_and_empty_table(spark):
    same = whiten(_frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert len(same) == 10 and {(int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same} == {(0, None, None, None)}
    flat = whiten(_frame(spark, [(i, [float(i), 2.0]) for i in range(5)])).collect()
    assert {r.explained for r in flat if r.component == 1} == {1.0} and {r.whitened for r in flat if r.component == 2} == {None}
    assert len(whiten(_frame(spark, [(1, [3.0])])).collect()) == 1
    none = _frame(spark, [(1, None)])
    assert whiten(none).count() == 0 and whiten(none.where("false")).count() == 0
    assert whiten(_frame(spark, [(1, []), (2, [])])).count() == 0


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(i, [((-1.0) ** i) * 2.0**37, float(i)]) for i in range(6)]
    got = whiten(_frame(spark, rows)).collect()
    deviations = dict(zip(range(6), _plain(rows)[2], strict=True))
    assert {r.vec_id: int(r.deviation) for r in got} == deviations and max(deviations.values()) > 2**63
    assert whiten(_frame(spark, [(1, [2.0**38])])).count() == 0


def test_parts_do_not_matter(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = [(i, (random.normal(size=4) * [1, 1, 5, 9]).tolist()) for i in range(300)]
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 20)
    for parts in (1, 7):
        _check(whiten(_frame(spark, rows, parts)).collect(), rows)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["random", "equal", "two clusters", "falling", "diagonal"])
def test_leading_pairs(size, kind):
    random = np.random.default_rng(size)
    turn = np.linalg.qr(random.normal(size=(size, size)))[0] if kind != "diagonal" else np.eye(size)
    values = {
        "random": random.uniform(0, 10, size), "equal": np.ones(size), "two clusters": np.repeat([5, 1e-9], [size // 2, size - size // 2]),
        "falling": 10.0 ** -np.arange(size), "diagonal": np.arange(size) * 1e6,
    }[kind]
    matrix = (turn * values) @ turn.T
    found, vectors = leading_pairs((matrix + matrix.T) / 2, 8)
    scale = max(values.max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1][:8]).max() < 1e-14 * size * scale
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_reflections_and_sturm_counts():
    matrix = np.random.default_rng(5).normal(size=(9, 9))
    matrix = matrix + matrix.T
    diagonal, off, _ = tridiagonal(matrix)
    values = np.linalg.eigvalsh(matrix)
    assert np.allclose(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)), values)
    at = (values[1:] + values[:-1]) / 2
    assert count_below(diagonal, off, at).tolist() == list(range(1, 9))
