"""Scaling and target transforms.

Fits are one aggregate (or the exact-quantile selection) over the training
frame; transforms are literal arithmetic, inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.stats import exact_quantiles_many


class AffineModel:
    """x → (x - shift) / scale per column, with the inverse."""

    def __init__(self, params: dict[str, tuple[float, float]]):
        self.params = params

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(s)) / F.lit(d)
                               for c, (s, d) in self.params.items() if c in df.columns})

    def inverse(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        cols = cols or [c for c in self.params if c in df.columns]
        return df.withColumns({c: F.col(c) * F.lit(self.params[c][1]) + F.lit(self.params[c][0]) for c in cols})


def fit_min_max(train: DataFrame, cols: Sequence[str]) -> AffineModel:
    """Min-max to [0, 1]; a constant column maps to 0 (range treated as 1)."""
    row = train.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    params = {}
    for c in cols:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        lo, hi = (float(lo), float(hi)) if lo is not None else (0.0, 0.0)  # no values: identity
        params[c] = (lo, (hi - lo) if hi > lo else 1.0)
    return AffineModel(params)


def fit_standardize(train: DataFrame, cols: Sequence[str]) -> AffineModel:
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    return AffineModel({c: (float(row[f"m_{c}"] or 0.0), float(row[f"s_{c}"]) if row[f"s_{c}"] else 1.0) for c in cols})


def fit_robust(train: DataFrame, cols: Sequence[str], quantile_range: tuple[float, float] = (25.0, 75.0)) -> AffineModel:
    """(x - median) / (q_hi - q_lo) with exact quantiles; zero range divides by 1."""
    lo, hi = quantile_range[0] / 100.0, quantile_range[1] / 100.0
    qs = exact_quantiles_many(train, cols, [0.5, lo, hi])
    params = {}
    for c in cols:
        med, a, b = (v if v is not None else 0.0 for v in qs[c])  # no values: identity
        params[c] = (med, (b - a) if (b - a) != 0 else 1.0)
    return AffineModel(params)


# ---------------------------------------------------------------------------
# Power transforms with a likelihood fit of lambda
# ---------------------------------------------------------------------------
def _grid(lo: float, hi: float, n: int) -> list[float]:
    return [lo + (hi - lo) * i / (n - 1) for i in range(n)]


def power_llf(df: DataFrame, col: str, lambdas: Sequence[float], method: str = "yeo-johnson") -> list[tuple[float, float]]:
    """Profile log-likelihood for every lambda, all in one aggregate pass."""
    x = F.col(col).cast("double")
    base = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    if method == "yeo-johnson":
        jac = F.sum(F.signum("x") * F.log1p(F.abs("x")))
        tf = C.yeo_johnson
    else:
        base = base.filter(F.col("x") > 0)
        jac = F.sum(F.log("x"))
        tf = C.box_cox
    aggs = [F.count(F.lit(1)).alias("n"), jac.alias("j")]
    aggs += [F.var_pop(tf("x", lam)).alias(f"v{i}") for i, lam in enumerate(lambdas)]
    r = base.agg(*aggs).first()
    n, j = r["n"], r["j"]
    import math
    out = []
    for i, lam in enumerate(lambdas):
        v = r[f"v{i}"]
        llf = float("-inf") if not v or v <= 0 else -n / 2.0 * math.log(v) + (lam - 1.0) * j
        out.append((lam, llf))
    return out


class PowerModel:
    def __init__(self, method: str, lambdas: dict[str, float], standardize: dict[str, tuple[float, float]] | None = None):
        self.method, self.lambdas, self.standardize = method, lambdas, standardize or {}

    def _fwd(self, c, lam):
        return C.yeo_johnson(c, lam) if self.method == "yeo-johnson" else C.box_cox(c, lam)

    def _inv(self, c, lam):
        return C.yeo_johnson_inverse(c, lam) if self.method == "yeo-johnson" else C.box_cox_inverse(c, lam)

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, lam in self.lambdas.items():
            e = self._fwd(F.col(c).cast("double"), lam)
            if c in self.standardize:
                m, s = self.standardize[c]
                e = (e - F.lit(m)) / F.lit(s)
            out[c] = e
        return df.withColumns(out)

    def inverse(self, df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
        """``mapping``: output column → fitted column whose lambda to use."""
        mapping = mapping or {c: c for c in self.lambdas}
        out = {}
        for target, src in mapping.items():
            e = F.col(target)
            if src in self.standardize:
                m, s = self.standardize[src]
                e = e * F.lit(s) + F.lit(m)
            out[target] = self._inv(e, self.lambdas[src])
        return df.withColumns(out)


def fit_power(train: DataFrame, cols: Sequence[str], method: str = "yeo-johnson", grid: int = 41,
              refine: int = 2, bounds: tuple[float, float] = (-2.0, 2.0), standardize: bool = False) -> PowerModel:
    """Lambda by maximum likelihood: a grid in one aggregate pass, then ``refine``
    finer grids around the argmax (each another single pass).  While the argmax
    is at an edge of ``bounds``, the bracket is moved there and doubled."""
    lambdas = {}
    for c in cols:
        lo, hi = bounds
        best = None
        for step in range(refine + 1):
            lams = _grid(lo, hi, grid if step == 0 else 21)
            llf = power_llf(train, c, lams, method)
            best = max(llf, key=lambda t: (t[1], -abs(t[0])))
            while step == 0 and best[0] in (lams[0], lams[-1]) and hi - lo < 64:
                half = hi - lo
                lo, hi = best[0] - half, best[0] + half
                lams = _grid(lo, hi, grid)
                llf = power_llf(train, c, lams, method)
                best = max(llf, key=lambda t: (t[1], -abs(t[0])))
            width = (hi - lo) / ((grid if step == 0 else 21) - 1)
            lo, hi = best[0] - width, best[0] + width
        lambdas[c] = best[0]
    model = PowerModel(method, lambdas)
    if standardize:
        t = model.transform(train)
        row = t.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
        model.standardize = {c: (float(row[f"m_{c}"]), float(row[f"s_{c}"]) or 1.0) for c in cols}
    return model
