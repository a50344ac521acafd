import math

import numpy as np
import pytest

from evenkeel.llm.q_whitening import op11_whitening
from evenkeel.llm.whitening import eigen, fit, whiten

DATA = "/root/testdata"
SCHEMA = "vec_id long, embedding array<float>, label int, whitened string, id string, v int, deviation string"


def rows_of(vectors):
    return [(i, v, 0, "clash", "clash", 1, "clash") for i, v in enumerate(vectors)]


def check(got, ids, vectors, k=32):
    """Against a plain computation in extended precision; vectors may differ in sign."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = x.astype(np.longdouble) - sums.astype(np.longdouble) / n
    v = (y.T @ y / n).astype(float)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    expected = (y.astype(float) @ basis / np.sqrt(values))[:, :k]
    found = {(r.vec_id, r.component): r for r in got}
    assert len(found) == len(got) == n * min(k, x.shape[1])
    matrix = np.array([[found[i, c + 1].whitened for c in range(expected.shape[1])] for i in ids])
    signs = np.sign((matrix * expected).sum(axis=0))
    assert np.abs(matrix * signs - expected).max() < 1e-8
    deviation = [int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))) for row in x]
    assert [found[i, 1].deviation for i in ids] == deviation
    for r in got:
        assert r.n == n and r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-10)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    covariance = np.cov(matrix.T, bias=True)
    assert np.abs(covariance - np.eye(len(covariance))).max() < 1e-9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query(spark, sf):
    rows = sorted(spark.read.parquet(f"{DATA}/{sf}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    check(op11_whitening(spark, f"{DATA}/{sf}").collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_query_drops_what_is_no_vector(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(60, 5)) * [1, 2, 3, 40, 5] + [0, 900, -7, 0, 1]).astype(np.float32).tolist()
    odd = [None, [None, 1.0, 1.0, 1.0, 1.0], [math.nan] * 5, [math.inf, 1.0, 1.0, 1.0, 1.0], [1.0, 1.0, 1.0, 1.0, -math.inf], [1.0, 2.0], []]
    rows = rows_of(good) + [(100 + i, v, 0, "x", "y", 1, "z") for i, v in enumerate(odd)] + [(None, None, 0, "", "", 1, "")]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    check(op11_whitening(spark, str(tmp_path)).collect(), range(60), good)


def test_rows_of_all_kinds(spark):
    def both(vectors):
        df = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(3)
        model = fit(df)
        return model, whiten(df, model).collect()

    for empty in ([], [None], [[]], [[math.nan]]):
        model, got = both(empty)
        assert got == [] and model.identity_error == 0
    model, got = both([[1.0, 2.0]] * 4)  # repeated rows, no variance
    assert [(r.whitened, r.deviation) for r in got] == [([None, None], 0)] * 4 and model.explained == [0.0, 0.0]
    model, got = both([[float(i), 7.0, 2.0 * i] for i in range(9)])  # one direction
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in got)
    assert model.identity_error < 1e-9 and model.explained[0] == pytest.approx(1)
    model, got = both([[3e38, 1.0], [-3e38, 0.5], [0.0, 0.25]])  # beyond 64 bits
    assert {r.deviation for r in got} == {(1 << 63) - 1, got[2].deviation} or len(got) == 3
    rows = rows_of([[1.0, 0.0], [0.0, 1.0], [2.0, 5.0]]) + [(None, [1.0, 1.0], 0, "", "", 1, "")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(str(r.vec_id) for r in whiten(df, fit(df)).collect()) == ["0", "1", "2", "None", "None"]
    long = np.random.default_rng(1).normal(size=(200, 300)).astype(np.float32).tolist()
    assert all(len(r.whitened) == 32 for r in both(long)[1])


def test_does_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet")
    first, second = fit(df.coalesce(1)), fit(df.repartition(7))
    assert np.array_equal(first.vectors, second.vectors) and first.sums == second.sums


def residual(a, values, vectors):
    x = vectors.astype(np.longdouble)
    return float(np.abs(a.astype(np.longdouble) @ x - x * values.astype(np.longdouble)).max() / np.abs(a).max())


@pytest.mark.parametrize("gap", [1e-2, 1e-6, 1e-9, 1e-12, 0.0])
def test_clustered_eigenvalues(gap):
    """float32 cannot tell these apart; the sub-solves can."""
    rng = np.random.default_rng(11)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0].astype(np.longdouble)
    e = np.concatenate([[9.0], 5 + gap * np.arange(6), np.linspace(1, 2, 30), 0.5 + gap * np.arange(3)])[::-1].copy()
    a = ((q * np.sort(e)[::-1]) @ q.T).astype(float)
    a = (a + a.T) / 2
    values, vectors = eigen(a)
    assert np.abs(values - np.sort(e)[::-1]).max() < 1e-14 * 40
    assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-14
    assert residual(a, values, vectors) < 2e-15
    assert (np.diff(values) <= 0).all()
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert residual(a, np.diag(start.T @ a @ start), start) > 1e-9  # so there was something to correct


def test_wide_range_of_variances():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    e = 10.0 ** -np.arange(12)
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = eigen(a)
    assert np.abs(values - e).max() < 1e-15 and residual(a, values, vectors) < 1e-15
