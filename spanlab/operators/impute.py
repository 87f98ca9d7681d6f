"""Missing-value profiling and imputation.

Fitted imputers follow one shape: ``fit_*(train, ...)`` runs the aggregate jobs
and keeps only scalars on the driver; ``model.transform(df)`` is a projection
with literals, so it is row-local and also scores a streaming frame.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.columns import hash_key
from ..functions.stats import exact_quantiles_many
from ..session import cut_lineage


def missing_report(df: DataFrame, ascending: bool = False) -> DataFrame:
    """Per column: missing count and percentage, only columns with missing values.

    One aggregate over all columns (a single scan), then ``unpivot``."""
    n = F.count(F.lit(1))
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]
    wide = df.agg(n.alias("__n"), *aggs)
    long = wide.unpivot(["__n"], df.columns, "column", "missing_count")
    out = (long.filter(F.col("missing_count") > 0)
           .select("column", F.col("missing_count").cast("long").alias("missing_count"),
                   F.round(F.col("missing_count") * 100.0 / F.col("__n"), 6).alias("missing_pct")))
    order = F.col("missing_count").asc() if ascending else F.col("missing_count").desc()
    return out.orderBy(order, "column")


def any_missing(df: DataFrame) -> DataFrame:
    flags = [F.max(F.col(c).isNull().cast("int")) for c in df.columns]
    return df.agg(F.greatest(*flags).cast("boolean").alias("any_missing"),
                  sum(flags[i] for i in range(len(flags))).cast("int").alias("columns_with_missing"))


def null_patterns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Joint missingness: a '0'/'1' pattern per row, grouped and counted."""
    cols = list(cols or df.columns)
    pattern = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


class FillModel:
    """Column → literal fill values (medians, means, modes)."""

    def __init__(self, values: dict[str, object], cast_double: bool = False):
        self.values = values
        self.cast_double = cast_double

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c in self.values:
                src = F.col(c).cast("double") if self.cast_double else F.col(c)
                v = self.values[c]
                out.append(F.coalesce(src, F.lit(v).cast(df.schema[c].dataType if not self.cast_double else "double"))
                           .alias(c) if v is not None else src.alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def fit_median(train: DataFrame, cols: Sequence[str]) -> FillModel:
    """Exact medians (bounded-memory distributed selection, see ``functions.stats``)."""
    qs = exact_quantiles_many(train, cols, [0.5])
    return FillModel({c: qs[c][0] for c in cols}, cast_double=True)


def fit_mean(train: DataFrame, cols: Sequence[str]) -> FillModel:
    row = train.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return FillModel({c: row[c] for c in cols}, cast_double=True)


def fit_mode(train: DataFrame, cols: Sequence[str]) -> FillModel:
    """Most frequent non-null value per column; ties → the smallest value.

    Columns of one type share a pass: (column, value) counts (partial
    aggregation, so a hot value is one row per task), then the best value of each
    column; one row per column reaches the driver."""
    values: dict = {c: None for c in cols}
    kinds: dict = {}
    for c in cols:
        kinds.setdefault(train.schema[c].dataType.simpleString(), []).append(c)
    for same in kinds.values():
        names = [f"c{i}" for i in range(len(same))]
        long = train.select(*[F.col(c).alias(n) for c, n in zip(same, names)]).unpivot([], names, "__col", "__val")
        n = long.filter("__val is not null").groupBy("__col", "__val").agg(F.count(F.lit(1)).alias("__n"))
        best = n.groupBy("__col").agg(F.min_by("__val", F.struct((-F.col("__n")).alias("n"), F.col("__val").alias("v"))).alias("__top"))
        values |= {same[names.index(r["__col"])]: r["__top"] for r in best.collect()}
    return FillModel(values)


def fill_random_level(df: DataFrame, col: str, levels: Sequence[str] = ("glossy", "matte"),
                      key: str = "id", seed: int | str = 0) -> DataFrame:
    """NULL → one of two levels with probability 1/2, seeded by a hash of the key
    (re-runnable, unlike ``rand()`` whose value depends on partitioning)."""
    first_half = F.substring(hash_key(key, seed), 1, 1) < F.lit("8")
    fill = F.when(first_half, levels[0]).otherwise(levels[1])
    return df.withColumn(col, F.coalesce(F.col(col), fill))


def fill_os_by_brand(df: DataFrame, keyword: str = "apple", brand: str = "brand", os: str = "os",
                     os_details: str = "os_details", compat: bool = False) -> DataFrame:
    """Missing OS from the brand: keyword match → macOS, else Windows.

    ``compat=True`` reproduces the reference's swapped Windows values."""
    # Fixed values (the fills of the reference rule)
    mac = ("macOS", "macOS Catalina")
    win = ("Windows 10", "Windows") if compat else ("Windows", "Windows 10")
    missing = F.col(os).isNull()
    is_mac = F.lower(F.col(brand)).contains(keyword.lower())
    return df.withColumns({
        os: F.when(missing & is_mac, mac[0]).when(missing, win[0]).otherwise(F.col(os)),
        os_details: F.when(missing & is_mac, mac[1]).when(missing, win[1]).otherwise(F.col(os_details)),
    })


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)).alias(c)
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)) else F.col(c) for c in df.columns])


class RegressionImputeModel:
    """Round-robin linear regression imputation; coefficients per column.

    ``transform`` starts a row's missing values at the training means and runs
    the fitted regressions over them in turn: the rounds of the fit, then the
    last round again until a row's fills would settle (``settle`` repeats), so
    values missing together are filled consistently.  With ``posterior=True`` a
    draw from the residual normal (sd per target from the fit) is added, seeded
    by ``hash(seed:target:key)`` so reruns give the same fills."""

    def __init__(self, coefs: dict[str, tuple[float, dict[str, float]]], means: dict[str, float] | None = None,
                 resid_sd: dict[str, float] | None = None, rounds: list | None = None, settle: int = 100):
        self.coefs, self.means, self.resid_sd = coefs, means or {}, resid_sd or {}
        self.rounds, self.settle = rounds or [coefs], settle

    def _fills(self, missing: tuple[str, ...]) -> dict[str, tuple[float, dict[str, float]]]:
        """Fills of a row that lacks ``missing`` as (constant, weights of the
        columns it has): the regressions composed on the driver, p x p numbers."""
        now: dict[str, tuple[float, dict[str, float]]] = {c: (self.means.get(c, 0.0), {}) for c in missing}
        for step in [*self.rounds, *[self.coefs] * self.settle]:
            moved = 0.0
            for t in missing:
                if t not in step:
                    continue
                const, weights = step[t][0], {}
                for x, b in step[t][1].items():
                    if x in now:
                        const += b * now[x][0]
                        for o, w in now[x][1].items():
                            weights[o] = weights.get(o, 0.0) + b * w
                    else:
                        weights[x] = weights.get(x, 0.0) + b
                old = now[t]
                moved = max([moved, abs(const - old[0]), *(abs(w - old[1].get(o, 0.0)) for o, w in weights.items())])
                now[t] = (const, weights)
            if moved < 1e-12:
                break
        return now

    def transform(self, df: DataFrame, posterior: bool = False, key: str = "id", seed: int = 0) -> DataFrame:
        from ..functions.columns import hash_unit, inverse_normal_sql

        lacking = sorted({c for t, (_, betas) in self.coefs.items() for c in (t, *betas)})
        # patterns of missing columns in the data: at most 2 ** columns, a row each
        mask = F.array(*[F.col(c).isNull() for c in lacking]).alias("m")
        patterns = [tuple(c for c, m in zip(lacking, r["m"]) if m) for r in df.select(mask).distinct().collect()]
        draws = [c for c in self.coefs if posterior and self.resid_sd.get(c)]
        out = df.withColumns({f"__u_{c}": F.greatest(F.least(hash_unit(key, f"{seed}:{c}"), F.lit(1 - 1e-12)),
                                                     F.lit(1e-12)) for c in draws}) if draws else df
        fills = {}
        known = {p: self._fills(p) for p in patterns if p}
        for c in self.coefs:
            pred = F.lit(None).cast("double")
            for p in (p for p in known if c in p):
                const, weights = known[p][c]
                value = F.lit(const)
                for x, b in weights.items():
                    value = value + F.lit(b) * F.col(x).cast("double")
                same = F.lit(True)
                for x in lacking:
                    same = same & (F.col(x).isNull() if x in p else F.col(x).isNotNull())
                pred = F.when(same, value).otherwise(pred)
            if c in draws:
                pred = pred + F.lit(self.resid_sd[c]) * F.expr(inverse_normal_sql(f"`__u_{c}`"))
            fills[c] = F.coalesce(F.col(c).cast("double"), pred)
        return out.withColumns(fills).drop(*[f"__u_{c}" for c in draws])


def regression_fill_one(train: DataFrame, target: str, predictor: str) -> tuple[float, float]:
    """Single-predictor least squares on complete pairs: (intercept, slope)."""
    r = train.agg(F.regr_intercept(target, predictor).alias("a"), F.regr_slope(target, predictor).alias("b")).first()
    return float(r["a"]), float(r["b"])


def fit_regression_impute(train: DataFrame, cols: Sequence[str], rounds: int = 10, tol: float = 1e-3,
                          ridge: float = 1e-9) -> RegressionImputeModel:
    """Iterative imputation: each round regresses every column with missing values
    on all the others (current fills), via one moment aggregate per column
    (X'X and X'y are p×p / p-vectors — tiny, whatever the row count) and a driver
    solve.  Stops after ``rounds`` or when the largest coefficient change < tol.
    Lineage is cut with a reliable checkpoint each round."""
    import numpy as np

    cols = list(cols)
    means = train.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    targets = [c for c in cols if train.filter(F.col(c).isNull()).limit(1).count() > 0]
    coefs = {c: (float(means[c] or 0.0), {}) for c in targets}
    cur = train.select(*[F.col(c).cast("double").alias(c) for c in cols]).withColumn(
        "__miss", F.array(*[F.col(c).isNull() for c in cols]))
    cur = FillModel({c: means[c] for c in cols}, cast_double=True).transform(cur)
    prev = None
    history = []
    for _ in range(rounds):
        new = {}
        for t in targets:  # in turn: each regression sees the fills of the ones before it
            xs = [c for c in cols if c != t]
            obs = cur.filter(~F.col("__miss")[cols.index(t)])
            terms = [F.lit(1.0)] + [F.col(x) for x in xs]
            aggs = []
            for i, a in enumerate(terms):
                for j, b in enumerate(terms):
                    if j >= i:
                        aggs.append(F.sum(a * b).alias(f"g{i}_{j}"))
                aggs.append(F.sum(a * F.col(t)).alias(f"r{i}"))
            m = obs.agg(*aggs).first()
            p = len(terms)
            G = np.zeros((p, p))
            r = np.zeros(p)
            for i in range(p):
                for j in range(i, p):
                    G[i, j] = G[j, i] = m[f"g{i}_{j}"] or 0.0
                r[i] = m[f"r{i}"] or 0.0
            beta = np.linalg.solve(G + ridge * np.eye(p), r)
            new[t] = (float(beta[0]), {x: float(b) for x, b in zip(xs, beta[1:])})
            pred = F.lit(new[t][0])
            for x, b in new[t][1].items():
                pred = pred + F.lit(b) * F.col(x)
            cur = cur.withColumn(t, F.when(F.col("__miss")[cols.index(t)], pred).otherwise(F.col(t)))
        coefs = new
        history.append(new)
        cur = cut_lineage(cur)
        flat = np.array([v for t in targets for v in [coefs[t][0], *coefs[t][1].values()]])
        if prev is not None and np.max(np.abs(flat - prev)) < tol:
            break
        prev = flat
    resid = {}
    for t, (b0, betas) in coefs.items():
        pred = F.lit(b0)
        for x, b in betas.items():
            pred = pred + F.lit(b) * F.col(x)
        obs = cur.filter(~F.col("__miss")[cols.index(t)])
        r = obs.agg(F.sum(F.pow(F.col(t) - pred, 2)).alias("sse"), F.count(F.lit(1)).alias("n")).first()
        dof = max(1, int(r["n"]) - len(betas) - 1)
        resid[t] = float(math.sqrt((r["sse"] or 0.0) / dof))
    return RegressionImputeModel(coefs, {c: float(means[c]) for c in cols if means[c] is not None}, resid, history)


# ---------------------------------------------------------------------------
# Nearest-neighbour imputation
# ---------------------------------------------------------------------------
def _dedupe_donors(donors: DataFrame, key: str, k: int, salts: int = 64) -> DataFrame:
    """Keep at most ``k`` donors (the smallest keys) per identical feature
    vector: with ties broken by key, no other member of an identical group can
    ever be among the k nearest.  Two stages (salted, then merged) so that a
    vector shared by a third of the rows is never one window partition."""
    from pyspark.sql import Window

    w1 = Window.partitionBy("vec", "__salt").orderBy(key)
    first = (donors.withColumn("__salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salts)))
             .withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k).drop("__r", "__salt"))
    w2 = Window.partitionBy("vec").orderBy(key)  # ≤ k × salts rows per vector now
    return first.withColumn("__r", F.row_number().over(w2)).filter(F.col("__r") <= k).drop("__r")


class KnnImputeModel:
    """Fills ``target`` from the k nearest donors: mean (numeric) or most frequent value, ties to the smallest (nominal).
    A row that shares no feature with any donor gets the donors' mean (their most frequent value); without donors the
    column stays as it is."""

    def __init__(self, target: str, donors: DataFrame, numeric: dict[str, float], levels: dict[str, DataFrame], k: int, key: str,
                 nominal: bool, power: int, fallback):
        self.target, self.donors, self.numeric, self.levels = target, donors, numeric, levels
        self.k, self.key, self.nominal, self.power, self.fallback = k, key, nominal, power, fallback

    def vectors(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        from .nearest import coded, row_vector

        rows, codes = coded(df, self.levels)
        vec = row_vector([F.col(c).cast("double") / F.lit(s) for c, s in self.numeric.items()] + [F.col(c) for c in codes.values()])
        return rows.select(*keep, vec.alias("vec"))

    def neighbours(self, df: DataFrame) -> DataFrame:
        """(key, nbr, dist, rank) of the rows whose target is missing."""
        from .nearest import nearest

        rec = self.vectors(df.filter(F.col(self.target).isNull()), [self.key])
        nn = nearest(rec, self.donors.select(self.key, "vec"), self.k, [False] * len(self.numeric) + [True] * len(self.levels), self.power, self.key)
        p = float(len(self.numeric) + len(self.levels))
        dist = F.sqrt("value") if self.power == 2 else F.col("value") / p
        return nn.select(self.key, "nbr", dist.alias("dist"), "rank")

    def transform(self, df: DataFrame) -> DataFrame:
        k, t = self.key, self.target
        nn = self.neighbours(df).join(self.donors.select(F.col(k).alias("nbr"), F.col(t).alias("__v")), "nbr")
        if self.nominal:
            cnt = nn.groupBy(k, "__v").agg(F.count(F.lit(1)).alias("__n"))
            fill = cnt.groupBy(k).agg(F.min_by("__v", F.struct((-F.col("__n")).alias("n"), F.col("__v").alias("v")))
                                      .alias("__fill"))
        else:
            fill = nn.groupBy(k).agg(F.avg("__v").alias("__fill"))
        kind = df.schema[t].dataType
        return (df.join(fill, k, "left").withColumn(t, F.coalesce(F.col(t), F.col("__fill").cast(kind), F.lit(self.fallback).cast(kind)))
                .drop("__fill"))


def _present(c: str) -> Column:
    """The number in a column; NaN counts as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None))


def fit_knn(train: DataFrame, target: str, features: Sequence[str], k: int = 5, key: str = "id") -> KnnImputeModel:
    """Numeric k-NN imputation (uniform weights) under the nan-Euclidean distance: p / present times the squared
    differences of the features that both rows have.  Donors are the training rows with ``target`` present; the
    neighbours are exact (``nearest``), the column mean stands in where nothing is shared."""
    model = KnnImputeModel(target, None, {c: 1.0 for c in features}, {}, k, key, False, 2, None)
    donors = model.vectors(train.filter(F.col(target).isNotNull()), [key, target])
    model.fallback = train.agg(F.avg(_present(target))).first()[0]
    model.donors = cut_lineage(_dedupe_donors(donors, key, k))
    return model


def fit_knn_nominal(train: DataFrame, target: str, numeric: Sequence[str], nominal: Sequence[str], k: int = 5,
                    key: str = "id") -> KnnImputeModel:
    """Nominal k-NN imputation under the Gower distance, majority vote: the mean, over the variables that both rows
    have, of |x - y| / range for numbers and of a 0/1 mismatch for factors.  Factors are dictionary codes (``nearest``),
    whatever their number of levels; ranges come from ``train`` in one aggregate."""
    from .nearest import dictionary

    num = list(numeric)
    r = train.agg(*[(F.max(_present(c)) - F.min(_present(c))).alias(c) for c in num]).first() if num else {}
    model = KnnImputeModel(target, None, {c: float(r[c]) if r[c] else 1.0 for c in num}, dictionary(train, list(nominal)), k, key, True, 1, None)
    donors = model.vectors(train.filter(F.col(target).isNotNull()), [key, target])
    votes = train.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("__n"))
    top = votes.orderBy(F.col("__n").desc(), F.col(target)).first()
    model.fallback = top[0] if top else None
    model.donors = cut_lineage(_dedupe_donors(donors, key, k))
    return model


@dataclass
class KnnColumnsModel:
    """One ``KnnImputeModel`` per column; every column is filled from the rows as they were."""
    models: list[KnnImputeModel]

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.models:
            cols = [m.key, m.target, *[c for c in m.numeric if c != m.target]]
            filled = m.transform(df.select(*cols)).select(F.col(m.key).alias("__k"), F.col(m.target).alias("__f"))
            out = out.join(filled, F.col(m.key) == F.col("__k"), "left").withColumn(m.target, F.coalesce(m.target, "__f")).drop("__k", "__f")
        return out


def fit_knn_columns(train: DataFrame, cols: Sequence[str], k: int = 5, key: str = "id") -> KnnColumnsModel:
    """Numeric k-NN imputation of several columns at once: each column that has missing values in ``train`` is filled
    from its k nearest donors by all the others."""
    gaps = train.agg(*[F.count(F.when(_present(c).isNull(), 1)).alias(c) for c in cols]).first()
    return KnnColumnsModel([fit_knn(train, c, [x for x in cols if x != c], k, key) for c in cols if gaps[c]])
