"""Linear solvers on one Gram aggregate.

``elastic_net_path``: one pass sums X'X, X'y and y'y for every fold; the whole path, and each fold's path on the other
folds (total minus the fold), is coordinate descent on those sums, and a fold's error is a quadratic form of its own.
The number of jobs does not depend on the number of penalties.

``fit_svr``: support-vector regression (epsilon-insensitive loss, L2 penalty) by ADMM with a variable for every row's
prediction.  A row's variables follow from the sequence of coefficients alone, so tasks replay them from the few
vectors that are broadcast; nothing is stored between iterations.

What reaches the driver are sums of d x d numbers (d: width of the feature vector, at most ``MAX_WIDTH``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import models as M
from .nearest import _stored

MAX_WIDTH = 4096


def _moments(rows: DataFrame, d: int, groups: int) -> list[np.ndarray]:
    """Per group the sums of z z' with z = (1, x, y), from rows (g, x, y): summed in each task, then pairwise by Spark."""
    if d > MAX_WIDTH:
        raise ValueError(f"{d} features; the Gram matrix is kept to {MAX_WIDTH}")

    def run(batches):
        total = [np.zeros((d + 2, d + 2)) for _ in range(groups)]
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            z, g = np.column_stack([np.ones(len(x)), x, b.column("y").to_numpy()]), b.column("g").to_numpy()
            for k in np.unique(g):
                total[k] += z[g == k].T @ z[g == k]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(groups, dtype=np.int32)), pa.array([t.tobytes() for t in total], pa.binary())], names=["g", "m"])

    def add(t: pa.Table) -> pa.Table:
        m = np.zeros((d + 2) * (d + 2))
        for v in t.column("m"):
            m += np.frombuffer(v.as_py())
        return pa.table({"g": t.column("g").slice(0, 1), "m": pa.array([m.tobytes()], pa.binary())})

    parts = rows.select("g", "x", "y").mapInArrow(run, "g int, m binary").withColumn("t", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = parts.groupBy("g", "t").applyInArrow(lambda t: add(t.drop(["t"])), "g int, m binary")  # at most 64 partial sums a group
    out = [np.zeros((d + 2, d + 2)) for _ in range(groups)]
    for r in some.groupBy("g").applyInArrow(add, "g int, m binary").collect():
        out[r["g"]] = np.frombuffer(r["m"]).reshape(d + 2, d + 2)
    return out


def _path(m: np.ndarray, lambdas: Sequence[float], alpha: float, tol: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients on the standardised features, intercept and coefficients on the raw ones) for each penalty, in the
    order given; warm starts from the largest penalty down."""
    n, d = m[0, 0], len(m) - 2
    mean, ybar = m[0, 1:-1] / n, m[0, -1] / n
    cov, r = m[1:-1, 1:-1] / n - np.outer(mean, mean), m[1:-1, -1] / n - mean * ybar
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    live = sd > 1e-9 * np.maximum(1.0, np.abs(mean))
    scale = np.where(live, sd, 1.0)
    c, r = cov / np.outer(scale, scale), np.where(live, r / scale, 0.0)
    beta, grad = np.zeros(d), r.copy()  # grad = r - C beta
    out, raw = np.zeros((len(lambdas), d)), np.zeros((len(lambdas), d + 1))
    top = max(1e-12, np.abs(r).max(initial=0.0))
    for k in sorted(range(len(lambdas)), key=lambda i: -lambdas[i]):
        lam = lambdas[k]
        active = np.flatnonzero(live & (beta != 0))
        while True:
            for _ in range(1_000):
                moved = 0.0
                for j in active:
                    g = grad[j] + beta[j] * c[j, j]
                    new = np.sign(g) * max(abs(g) - lam * alpha, 0.0) / (c[j, j] + lam * (1 - alpha))
                    step = new - beta[j]
                    if step:
                        grad -= step * c[j]
                        beta[j] = new
                        moved = max(moved, abs(step))
                if moved < tol * top:
                    break
            wrong = live & (beta == 0) & (np.abs(grad) > lam * alpha + tol * top)
            if not wrong.any():
                break
            active = np.union1d(active, np.flatnonzero(wrong))
        out[k] = beta
        raw[k, 1:] = beta / scale
        raw[k, 0] = ybar - raw[k, 1:] @ mean
    return out, raw


def elastic_net_path(train: DataFrame, label: str, lambdas: Sequence[float], alpha: float = 1.0, folds: int = 5, key: str = "id", seed: int = 0,
                     optimum: float | None = None, least: float = 0.1, numeric: Sequence[str] = M.NUMERIC,
                     categorical: Sequence[str] = M.CATEGORICAL) -> DataFrame:
    """(lambda, term, estimate, cv_mse, nearest, labelled): coefficients on standardised features along the path,
    without the intercept.  ``nearest`` marks the penalty nearest (in its logarithm) to ``optimum``, by default that of
    least cross-validated error; ``labelled`` the terms of at least ``least`` in size there."""
    from .sample import with_folds

    lambdas = [float(v) for v in lambdas]
    data = M.cast_numeric(with_folds(train.filter(F.col(label).isNotNull()), folds, key, shuffle=True, seed=seed), numeric)
    prep = Pipeline(stages=M.preprocessing(numeric, categorical)).fit(data)
    feats = prep.transform(data)
    names = M.feature_names(feats)
    parts = _moments(feats.select(F.col("fold").cast("int").alias("g"), vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y")), len(names), folds)
    total = sum(parts)
    beta, _ = _path(total, lambdas, alpha)
    sse = np.zeros(len(lambdas))
    for held in parts:
        if held[0, 0] and total[0, 0] > held[0, 0]:
            w = np.column_stack([_path(total - held, lambdas, alpha)[1], -np.ones(len(lambdas))])
            sse += np.einsum("ij,jk,ik->i", w, held, w)
    mse = np.maximum(sse, 0.0) / max(1.0, total[0, 0])
    best = lambdas[int(np.argmin(mse))] if optimum is None else optimum
    near = int(np.argmin([abs(math.log(max(v, 1e-300)) - math.log(max(best, 1e-300))) for v in lambdas]))
    rows = [(lambdas[i], names[j], float(beta[i, j]), float(mse[i]), i == near, bool(i == near and abs(beta[i, j]) >= least)) for i in range(len(lambdas)) for j in range(len(names))]
    return train.sparkSession.createDataFrame(rows, "lambda double, term string, estimate double, cv_mse double, nearest boolean, labelled boolean")


# ---------------------------------------------------------------------------
# Support-vector regression on random Fourier features
# ---------------------------------------------------------------------------
def _replay(x: np.ndarray, y: np.ndarray, betas: np.ndarray, rho: float, cost: float, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row's variable, scaled dual and prediction after the coefficients ``betas`` (one a row)."""
    r, w = np.zeros(len(y)), np.zeros(len(y))
    p = np.zeros(len(y))
    for fit in (x @ betas.T).T if len(betas) else []:
        p = fit
        e = p - w - y  # least cost * max(0, |e| - eps) + rho / 2 (e' - e)**2
        e = np.where(np.abs(e) <= eps, e, np.where(np.abs(e) <= eps + cost / rho, np.sign(e) * eps, e - np.sign(e) * cost / rho))
        r = y + e
        w = w + r - p
    return r, w, p


@dataclass
class SVRModel:
    """Coefficients over the features of ``rff`` (the last one is the intercept's), targets as (y - centre) / scale."""
    rff: M.RFFModel
    beta: np.ndarray
    centre: float
    scale: float
    history: list[tuple[float, float, float]]

    def transform(self, df: DataFrame, key: str = "id", out: str = "prediction") -> DataFrame:
        beta, c, s = self.beta, self.centre, self.scale
        rows = self.rff.features(df).select(key, vector_to_array("rff").alias("x"))
        kind = rows.schema[key].dataType.simpleString()

        def run(batches):
            for b in batches:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(beta) - 1)
                yield pa.RecordBatch.from_arrays([b.column(key), pa.array(c + s * (x @ beta[:-1] + beta[-1]))], names=[key, out])
        return rows.mapInArrow(run, f"`{key}` {kind}, `{out}` double")


def _inverse(a: np.ndarray) -> np.ndarray:
    """Inverse of a positive definite matrix by sweeps of plain array operations.  (The threaded LAPACK call was seen
    to stall in the driver process from about 100 columns on.)"""
    a = a.copy()
    for k in range(len(a)):
        row, col, p = a[k] / a[k, k], a[:, k].copy(), a[k, k]
        a -= col[:, None] * row
        a[k], a[:, k] = row, -col / p
        a[k, k] = 1.0 / p
    return a


def solve_svr(rows: DataFrame, d: int, cost: float, eps: float, rho: float = 1.0, iterations: int = 100, tol: float = 1e-4) -> tuple[np.ndarray, list]:
    """Minimise |beta|² / 2 + cost Σ max(0, |y - x·beta| - eps) over rows (x, y): ADMM, one job an iteration.  Ends when
    primal and dual residuals are below ``tol`` of their scale; returns the coefficients and (loss, primal, dual) by
    iteration."""
    m = _moments(rows.withColumn("g", F.lit(0)), d, 1)[0]
    n = m[0, 0]
    solve = _inverse(np.eye(d) / rho + m[1:-1, 1:-1])
    betas, history, before = np.zeros((0, d)), [], np.zeros(d)
    for _ in range(iterations if n else 0):
        now = betas

        def run(batches):
            xr, loss, primal, norm = np.zeros(d), 0.0, 0.0, 0.0
            for b in batches:
                if b.num_rows:
                    x, y = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d), b.column("y").to_numpy()
                    r, w, p = _replay(x, y, now, rho, cost, eps)
                    xr += x.T @ (r + w)
                    loss += cost * np.maximum(np.abs(y - p) - eps, 0.0).sum()
                    primal += ((r - p) ** 2).sum()
                    norm += (r ** 2).sum()
            out = np.append(xr, [loss, primal, norm])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out)], names=["i", "v"])

        # d + 3 rows a task, summed by place in Spark
        got = rows.select("x", "y").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        sums = np.zeros(d + 3)
        for r in got:
            sums[r["i"]] = r["v"]
        new, got = solve @ sums[:d], dict(zip("lpn", sums[d:].tolist()))
        if len(betas):
            last = betas[-1]
            dual = rho * np.linalg.norm(m[1:-1, 1:-1] @ (last - before)) / max(1.0, math.sqrt(n))
            history.append((got["l"] + 0.5 * float(last @ last), math.sqrt(got["p"]), float(dual)))
            if math.sqrt(got["p"]) <= tol * max(1.0, math.sqrt(got["n"])) and dual <= tol * max(1.0, rho * math.sqrt(n)):
                break
            before = last
        betas = np.vstack([betas, new])
    return (betas[-1] if len(betas) else np.zeros(d)), history


def fit_svr(train: DataFrame, label: str, gamma: float = 0.05, n_components: int = 100, cost: float = 1.0, eps: float = 0.1, seed: int = 0,
            numeric: Sequence[str] = M.NUMERIC, categorical: Sequence[str] = M.CATEGORICAL, rho: float = 1.0, iterations: int = 60) -> SVRModel:
    """Epsilon-insensitive regression with an RBF kernel by random Fourier features; the target is standardised."""
    data = train.filter(F.col(label).isNotNull())
    rff = M.fit_rff_features(data, gamma, n_components, seed, numeric, categorical)
    t = data.agg(F.avg(F.col(label).cast("double")).alias("m"), F.stddev_pop(F.col(label).cast("double")).alias("s")).first()
    centre, scale = float(t["m"] or 0.0), float(t["s"] or 1.0)
    rows = _stored(rff.features(data).select(F.concat(vector_to_array("rff"), F.array(F.lit(1.0))).alias("x"),
                                             ((F.col(label).cast("double") - centre) / scale).alias("y")), "svr")
    beta, history = solve_svr(rows, n_components + 1, cost, eps, rho, iterations)
    return SVRModel(rff, beta, centre, scale, history)
