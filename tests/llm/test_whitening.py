"""Whitening against plain numpy, and the spectral splits on hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest

from quillsift.llm import whitening

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, vector INT"


def brute(rows, wanted=whitening.COMPONENTS):
    """(vec_id, component) -> values, by numpy.linalg.eigh."""
    kept = [
        (i, e) for i, e in rows
        if e is not None and all(v is not None and math.isfinite(v) for v in e)
    ]
    x = [[math.floor(64 * float(np.float32(v))) + 1_000_000 for v in e] for _, e in kept]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    mean = np.array([s / n for s in sums])
    y = np.array(x, dtype=np.float64) - mean
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    out = []
    for (vec_id, _), own, row in zip(kept, x, y, strict=True):
        deviation = sum((n * v - s) ** 2 for v, s in zip(own, sums, strict=True))
        white = row @ vectors / np.sqrt(values)
        share = values / np.trace(y.T @ y / n)
        out += [(vec_id, k + 1, n, deviation, white[k], share[k]) for k in range(len(values))]
    return out


def compared(spark, rows):
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA).repartition(3)
    found = whitening.whiten_embeddings(spark, df).collect()
    want = brute(rows)
    assert len(found) == len(want)
    found = {(r.vec_id, r.component): r for r in found}
    sign = {}
    for vec_id, k, n, deviation, white, share in want:
        r = found[vec_id, k]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(share, rel=1e-9)
        if abs(white) > 1e-3:
            sign.setdefault(k, np.sign(white) * np.sign(r.whitened))
        assert r.whitened == pytest.approx(sign.get(k, 1) * white, abs=1e-6)
        assert r.identity_error <= 1e-9
    return found


def test_agrees_with_numpy(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    compared(spark, [tuple(r) for r in rows.collect()])


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=5) * (1, 2, 3, 4, 5)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [float("nan")] + [0.0] * 4)]
    rows += [(63, [float("inf")] + [0.0] * 4)]
    found = compared(spark, rows)
    assert {k for _, k in found} == set(range(1, 6))
    assert all(r.n == 60 for r in found.values())
    # Other lengths, empty vectors, missing and repeated ids.
    more = [(64, []), (65, [1.0]), (None, [1.0] * 5), (5, [2.0] * 5)]
    df = spark.createDataFrame([(i, e, 0) for i, e in rows + more], SCHEMA)
    out = whitening.whiten_embeddings(spark, df).collect()
    assert len(out) == 62 * 5 and {r.n for r in out} == {62}
    assert sum(r.vec_id is None for r in out) == 5 and sum(r.vec_id == 5 for r in out) == 10


def test_no_rows_and_no_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten_embeddings(spark, empty).count() == 0
    alike = spark.createDataFrame([(i, [0.5, 0.25], 0) for i in range(4)], SCHEMA)
    rows = whitening.whiten_embeddings(spark, alike).collect()
    assert {(r.component, r.deviation, r.whitened, r.explained) for r in rows} == {
        (1, 0, None, None), (2, 0, None, None)
    }
    line = spark.createDataFrame([(i, [float(i), float(2 * i)], 0) for i in range(5)], SCHEMA)
    rows = whitening.whiten_embeddings(spark, line).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in rows)


def test_large_means_and_deviations_are_exact(spark):
    rows = [(i, [1e7 + (i * 37 % 101) / 64, -(2.0**30) * (i % 3), i / 7]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    x = [[math.floor(64 * v) + 1_000_000 for v in e] for _, e in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((50 * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
    small = df.select("vec_id", "embedding")
    if max(want.values()) >= 1 << 63:
        with pytest.raises(Exception, match="too large|out of bounds|convert"):
            whitening.whiten_embeddings(spark, small).collect()
        small = small.selectExpr("vec_id", "array(embedding[0], embedding[2]) AS embedding")
        x = [[r[0], r[2]] for r in x]
        sums = [sums[0], sums[2]]
        want = {
            i: sum((50 * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for i, r in enumerate(x)
        }
    found = whitening.whiten_embeddings(spark, small).collect()
    assert {r.vec_id: r.deviation for r in found} == want


def spectra():
    rng = np.random.default_rng(1)

    def turned(values):
        q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
        return (q * values) @ q.T

    return {
        "even": turned(rng.uniform(60, 90, 64)),
        "geometric": turned(2.0 ** -np.arange(40)),
        "repeated": turned(np.r_[np.full(20, 5.0), np.full(20, 3.0), 2.0]),
        "close": turned(np.r_[1 + 1e-10 * np.arange(30), 5.0]),
        "rank one": turned(np.r_[7.0, np.zeros(15)]),
        "both signs": turned(np.array([-1.0, 1, -2, 2, 0])),
        "diagonal": np.diag(np.arange(1.0, 33)),
        "scalar": np.eye(10) * 3,
        "zero": np.zeros((8, 8)),
        "single": np.array([[4.0]]),
    }


@pytest.mark.parametrize("name", spectra())
def test_components_of_hard_spectra(name):
    matrix = spectra()[name]
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.components(matrix, 32)
    want = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    size = np.linalg.norm(matrix) + 1e-300
    assert len(values) == min(32, len(matrix))
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.linalg.norm(matrix @ vectors - vectors * values) <= 1e-13 * size
    assert np.linalg.norm(vectors.T @ vectors - np.eye(len(values))) <= 1e-12


def test_polar_factor_is_the_sign():
    matrix = spectra()["even"] - 75 * np.eye(64)
    sign = whitening.polar_factor(matrix)
    assert np.linalg.norm(sign @ sign - np.eye(64)) < 1e-12
    assert np.linalg.norm(sign @ matrix - matrix @ sign) < 1e-10
    assert np.linalg.eigvalsh(sign @ matrix).min() > 0
