"""The coefficient path against single fits, and support-vector regression against its dual."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from spanlab.operators import linear as LN
from spanlab.operators import models as M
from spanlab.operators.sample import with_folds


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        a, b, c = rng.normal(size=3)
        f = "xyz"[int(rng.integers(0, 3))]
        rows.append((i, float(a), float(a * 0.9 + 0.2 * b), None if i % 13 == 0 else float(c), 1.0, f, float(3 * a - 2 * c + (5 if f == "y" else 0) + rng.normal() * 0.5)))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, one double, f string, y double").repartition(4)


@pytest.mark.parametrize("alpha", [1.0, 0.5])
def test_path_is_optimal_and_folds_are_held_out(data, alpha):
    lambdas = [2.0, 0.5, 0.1, 0.01]
    kw = dict(numeric=["a", "b", "c", "one"], categorical=["f"])
    got = LN.elastic_net_path(data, "y", lambdas, alpha, folds=4, **kw).collect()
    folds = M.cast_numeric(with_folds(data, 4, "id", shuffle=True, seed=0), kw["numeric"])
    prep = Pipeline(stages=M.preprocessing(**kw)).fit(folds)
    pdf = prep.transform(folds).select("features", "y", "fold").toPandas()
    names = M.feature_names(prep.transform(folds))
    raw, y, fold = np.array([v.toArray() for v in pdf["features"]]), pdf["y"].to_numpy(), pdf["fold"].to_numpy()
    sd = np.where(raw.std(axis=0) > 0, raw.std(axis=0), 1.0)
    x = (raw - raw.mean(axis=0)) / sd
    for lam in lambdas:
        mine = {r["term"]: r["estimate"] for r in got if r["lambda"] == lam}
        assert mine["one__i"] == 0.0
        beta = np.array([mine[n] for n in names])
        grad = x.T @ (y - y.mean() - x @ beta) / len(y)
        pull = grad - lam * (1 - alpha) * beta  # optimality of the elastic net
        assert np.allclose(pull[beta != 0], lam * alpha * np.sign(beta[beta != 0]), atol=2e-4)
        assert (np.abs(pull[beta == 0]) <= lam * alpha + 2e-4).all()
    lam, sse = 0.1, 0.0
    for f in range(4):  # fits on the other folds' rows alone, their errors row by row
        z = np.column_stack([np.ones((fold != f).sum()), raw[fold != f], y[fold != f]])
        _, coef = LN._path(z.T @ z, lambdas, alpha)
        sse += ((y[fold == f] - coef[2, 0] - raw[fold == f] @ coef[2, 1:]) ** 2).sum()
    assert next(r["cv_mse"] for r in got if r["lambda"] == lam) == pytest.approx(sse / len(y), rel=1e-3)
    best = min(got, key=lambda r: r["cv_mse"])["lambda"]
    assert {r["lambda"] for r in got if r["nearest"]} == {best}
    assert {r["term"] for r in got if r["labelled"]} == {r["term"] for r in got if r["lambda"] == best and abs(r["estimate"]) >= 0.1}


def _dual(x, y, cost, eps, passes=3000):
    """Coordinate ascent on the dual; beta = Σ a_i x_i, |a_i| <= cost."""
    a, beta, h = np.zeros(len(y)), np.zeros(x.shape[1]), (x ** 2).sum(1)
    for _ in range(passes):
        moved = 0.0
        for i in range(len(y)):
            g = a[i] * h[i] + y[i] - x[i] @ beta
            new = np.clip(np.sign(g) * max(abs(g) - eps, 0.0) / h[i], -cost, cost)
            if new != a[i]:
                beta += (new - a[i]) * x[i]
                moved, a[i] = max(moved, abs(new - a[i])), new
        if moved < 1e-9:
            break
    return beta, a


@pytest.mark.parametrize("cost,eps", [(1.0, 0.1), (0.05, 0.3)])
def test_svr_reaches_the_minimum(spark, cost, eps):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.normal(size=(120, 4)), np.ones(120)])
    y = x @ np.array([1.0, -2.0, 0.0, 0.5, 0.7]) + rng.normal(size=120) * 0.4
    rows = spark.createDataFrame([(list(map(float, r)), float(v)) for r, v in zip(x, y)], "x array<double>, y double").repartition(3)
    beta, history = LN.solve_svr(rows, 5, cost, eps, iterations=100, tol=1e-5)
    want, a = _dual(x, y, cost, eps)

    def objective(b):
        return 0.5 * b @ b + cost * np.maximum(np.abs(y - x @ b) - eps, 0).sum()
    assert objective(beta) == pytest.approx(objective(want), rel=1e-3)
    assert np.allclose(beta, want, atol=3e-2)
    gap = objective(beta) - (a @ y - eps * np.abs(a).sum() - 0.5 * want @ want)
    assert 0 <= gap + 1e-6 and gap < 2e-3 * objective(want)
    assert history[-1][1] < history[0][1]


def test_svr_learns_and_survives_no_rows(data):
    kw = dict(numeric=["a", "b", "c"], categorical=["f"])
    m = LN.fit_svr(data, "y", gamma=0.05, n_components=60, cost=2.0, eps=0.05, iterations=25, **kw)
    got = m.transform(data).join(data, "id").agg(F.avg(F.abs(F.col("prediction") - F.col("y"))), F.avg(F.abs(F.col("y")))).first()
    assert got[0] < 0.35 * got[1]
    beta, history = LN.solve_svr(data.limit(0).select(F.array("a").alias("x"), "y"), 1, 1.0, 0.1)
    assert beta.tolist() == [0.0] and history == []


def test_inverse_by_sweeps():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 120))
    a = x.T @ x + np.eye(120)
    assert np.allclose(LN._inverse(a) @ a, np.eye(120), atol=1e-9)
