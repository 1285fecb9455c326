"""Whitening against numpy's eigenvectors and exact integer sums."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwarden.llm.queries import QUERIES
from fleetwarden.llm.whitening import inertia, leading, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k=8):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} of rows that count."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n = len(x)
    if not n:
        return {}
    sums = [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    values, columns = np.linalg.eigh(cov)
    values, columns = values[::-1], columns[:, ::-1]
    k = min(k, int((values > 1e-9 * max(values.max(), 1e-300)).sum()))
    out = []
    for (i, _), row, c in zip(kept, x, centred, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        for j in range(k):
            w = c @ columns[:, j] / values[j] ** 0.5
            out.append(((i, j + 1), (n, deviation, abs(w), values[j] / np.trace(cov))))
    return dict(out) if len({a for a, _ in out}) == len(out) else out


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        n, deviation, w, share = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - w) < 1e-7 and abs(r["explained"] - share) < 1e-10 * share + 1e-15
        assert r["identity_error"] < 1e-9


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = QUERIES["op13_whitening"](spark, sf_dir).collect()
    check(got, plain([tuple(r) for r in rows]))
    # One sign per component for all rows.
    first = np.array([[r["whitened"] for r in got if r["component"] == j] for j in (1, 8)])
    assert abs(first.mean(1)).max() < 1e-9 and abs((first**2).mean(1) - 1).max() < 1e-9


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).round(3).tolist(), 1) for i in range(40)]
    odd = [
        (100, None, 1), (101, [], None), (102, [1.0, None, 2.0, 3.0], 0), (103, [math.nan, 1.0, 1.0, 1.0], 0),
        (104, [math.inf, 1.0, 1.0, 1.0], 0), (105, [1.0, 2.0], 0),
    ]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    for name in ("n", "vector", "at", "component", "whitened"):
        df = df.withColumn(name, F.lit("x"))
    check(whiten(df).collect(), plain([(i, v) for i, v, _ in rows]))


def test_ties_repeats_and_low_rank(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 5.0], 0), (1, [1.0, 2.0, 5.0], 0), (None, [3.0, 2.0, 5.0], 0)], SCHEMA)
    got = whiten(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"]) for r in got) == [
        (0, 1, 3, 4096**2), (1, 1, 3, 2048**2), (1, 1, 3, 2048**2),
    ]
    assert all(abs(r["explained"] - 1) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], SCHEMA)
    assert whiten(same).collect() == []
    assert whiten(df.limit(0)).collect() == [] and whiten(df.limit(0)).columns[:2] == ["vec_id", "component"]


def test_large_values_stay_exact(spark):
    rows = [(i, [float(4_000 * (i % 3)), float(i), -3.5e6], 0) for i in range(50)]
    check(whiten(spark.createDataFrame(rows, SCHEMA)).collect(), plain([(i, v) for i, v, _ in rows]))
    huge = [(i, [float(2**40 * (i % 2)), 1.0], 0) for i in range(4)]
    assert [r["deviation"] for r in whiten(spark.createDataFrame(huge, SCHEMA)).collect()] == [None] * 4


@pytest.mark.parametrize("values", [[5, 5, 5, 4, 4, 3, 1, 1], [9, 1e-3, 1e-6, 0, 0], [1], [2, 2 - 1e-10, 2 - 2e-10, 1]])
def test_clusters_and_counts(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    got, columns = leading(a, 8)
    assert np.allclose(got, [v for v in values if v > 0][:8], rtol=1e-9, atol=1e-12)
    assert np.abs(columns.T @ columns - np.eye(len(got))).max() < 1e-12
    assert np.abs(a @ columns - columns * got).max() < 1e-11
    for shift in (-1.0, 0.5, 2.5, 4.5, 10.0):
        assert inertia(a, shift) == sum(v > shift for v in values)
