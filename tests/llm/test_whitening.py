"""Whitening against numpy's own eigenvectors and exact integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from snaptrail.llm import queries as llm
from snaptrail.llm.whitening import components, fit, polar, whiten

SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def expected(rows, most=4):
    """By vec_id and component: n, deviation, whitened and explained, of rows whose vector is usable."""
    usable = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v is not None and None not in v]
    usable = [(i, [math.floor(256 * c) for c in v]) for i, v in usable if all(map(math.isfinite, v))]
    fitted = sorted({tuple(x) for _, x in usable})
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fitted])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors.T[::-1][:most]
    found = {}
    for i, x in usable:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        away = np.array([c - s / n for c, s in zip(x, sums)])
        for k, (e, v) in enumerate(zip(values, vectors)):
            found[i, k + 1] = (n, deviation, away @ v / np.sqrt(e), e / np.trace(covariance))
    return found


def check(rows, found):
    signs = {}
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) and got.keys() == found.keys()
    for (i, k), (n, deviation, white, part) in found.items():
        row = got[i, k]
        assert (row.n, int(row.deviation)) == (n, deviation)
        assert row.identity_error <= 1e-9 and row.explained == pytest.approx(part, rel=1e-9)
        if abs(white) > 1e-3:
            assert signs.setdefault(k, np.sign(white * row.whitened)) == np.sign(white * row.whitened)
        assert abs(row.whitened) == pytest.approx(abs(white), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("kind", ["full", "low rank", "equal", "zero", "graded", "one", "clusters"])
def test_components_are_eigenvectors(kind):
    random_ = np.random.default_rng(3)
    basis = np.linalg.qr(random_.standard_normal((24, 24)))[0]
    values = {
        "full": random_.random(24) + 0.1,
        "low rank": np.array([3.0, 2, 1] + [0] * 21),
        "equal": np.full(24, 2.0),
        "zero": np.zeros(24),
        "graded": np.logspace(6, -6, 24),
        "one": None,
        "clusters": np.array([5.0] * 8 + [1.0] * 16),
    }[kind]
    matrix = np.array([[4.0]]) if values is None else basis @ np.diag(values) @ basis.T
    found, vectors = components(matrix)
    assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1], atol=1e-13 * max(1, np.abs(matrix).max()))
    assert np.allclose(vectors @ vectors.T, np.eye(len(matrix)), atol=1e-13)
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() <= 1e-13 * max(1, np.abs(matrix).max())
    first, vector = components(matrix, 1)
    assert len(first) == 1 and np.isclose(first[0], found[0]) and vector.shape == (1, len(matrix))


def test_polar_factor_is_the_sign():
    matrix = np.random.default_rng(4).standard_normal((9, 9))
    matrix = matrix + matrix.T
    values, vectors = np.linalg.eigh(matrix)
    assert np.allclose(polar(matrix), vectors @ np.diag(np.sign(values)) @ vectors.T, atol=1e-12)


def test_edges(spark):
    """Nulls, infinite entries, repeated vectors and ids, a null id, large offsets, clashing columns, empty tables."""
    random.seed(1)
    rows = [(i, [random.gauss(1e4 if d == 2 else 0, 3 - d / 2) for d in range(5)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(None, rows[1][1])]
    odd = [(200, None), (201, [1.0, None, 2.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [0.0, 0.0, 0.0, float("-inf")])]
    schema = VECTORS + ", x int, component string, n double"
    table = spark.createDataFrame([(*r, 1, 2, "c", 0.5) for r in rows + odd], schema).repartition(4)
    check(whiten(table, fit(table)).collect(), expected(rows))
    model = fit(table.union(table))
    assert (model.n, len(model.values)) == (60, 4)
    for none in (table.limit(0), table.where("vec_id >= 200"), table.where("vec_id = 5")):
        assert whiten(none, fit(none)).collect() == []
    repeated = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3 + [(1, [2.0, 2.0], 0)], VECTORS)
    found = whiten(repeated, fit(repeated)).collect()
    assert [r.component for r in found] == [1] * 4 and sorted(abs(r.whitened) for r in found) == [1.0] * 4


def test_sums_beyond_a_long_stay_exact(spark):
    rows = [(i, [float(np.float32(3e13 + i * 1e9)), float(i), 1.0]) for i in range(200)]
    short = [(300, [1.0]), (301, [])]
    table = spark.createDataFrame([(*r, 0) for r in rows + short], VECTORS)
    filled = [(i, v + [0.0] * (3 - len(v))) for i, v in rows + short]
    found = {(r.vec_id, r.component): int(r.deviation) for r in whiten(table, fit(table)).collect()}
    assert found == {key: value[1] for key, value in expected(filled).items() if key[1] <= max(k for _, k in found)}


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    result = llm.queries()["op12_whitening"](spark, SF_DIR)
    types = ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    assert [kind for _, kind in result.dtypes] == types
    check(result.collect(), expected(rows))
