"""Interval regression: preprocessing pipeline, one regressor per price label,
target transforms and the model families of SURVEY §2.10 (M1-M15, K8, K13).

Every fit is a ``pyspark.ml`` estimator running as Spark jobs; the driver only
holds fitted parameters (trees, coefficients, level lists, a few scalars).
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (Imputer, MinMaxScaler, OneHotEncoder, PolynomialExpansion, RobustScaler,
                                StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import cut_lineage
from . import scale

LABELS = ("min_price", "max_price")
OUT = {"min_price": "MIN", "max_price": "MAX"}
NUMERIC = ["screen_size", "pixels_x", "pixels_y", "touchscreen", "detachable_keyboard", "discrete_gpu",
           "ram", "ssd", "storage", "weight"]
CATEGORICAL = ["brand", "screen_surface", "cpu", "gpu", "os"]
MAX_TREE_DEPTH = 30  # Spark's limit


# ---------------------------------------------------------------------------
# Preprocessing (E8, E12): numeric impute (+ scale), categorical one-hot, assemble
# ---------------------------------------------------------------------------
def cast_numeric(df: DataFrame, numeric: Sequence[str] = NUMERIC) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def preprocessing(numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
                  impute: str = "median", scaler: str | None = None, out: str = "features") -> list:
    """Stages of the column-transformer: numeric branch (impute → optional scale)
    and categorical branch (index with NULL/unseen kept → one-hot), one vector."""
    stages: list = []
    num_in = list(numeric)
    if impute and num_in:
        stages.append(Imputer(strategy=impute, inputCols=num_in, outputCols=[f"{c}__i" for c in num_in]))
        num_in = [f"{c}__i" for c in num_in]
    num_vec = num_in
    if scaler and num_in:
        stages.append(VectorAssembler(inputCols=num_in, outputCol="__num", handleInvalid="keep"))
        if scaler == "standard":
            stages.append(StandardScaler(inputCol="__num", outputCol="__nums", withMean=True, withStd=True))
        elif scaler == "robust":
            stages.append(RobustScaler(inputCol="__num", outputCol="__nums", withCentering=True))
        elif scaler == "minmax":
            stages.append(MinMaxScaler(inputCol="__num", outputCol="__nums"))
        else:
            raise ValueError(scaler)
        num_vec = ["__nums"]
    cats = list(categorical)
    if cats:
        stages.append(StringIndexer(inputCols=cats, outputCols=[f"{c}__x" for c in cats], handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__x" for c in cats], outputCols=[f"{c}__o" for c in cats],
                                    handleInvalid="keep", dropLast=True))
    stages.append(VectorAssembler(inputCols=num_vec + [f"{c}__o" for c in cats], outputCol=out,
                                  handleInvalid="keep"))
    return stages


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names from the vector's ML attribute metadata (never positional guesses)."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    names = {}
    for group in attrs.values():
        for a in group:
            names[a["idx"]] = a.get("name", f"f{a['idx']}")
    n = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(n)]


# ---------------------------------------------------------------------------
# Estimators (M1-M5, M8)
# ---------------------------------------------------------------------------
def estimator(kind: str, label: str, prediction: str = "prediction", features: str = "features",
              weight: str | None = None, **params):
    """One Spark regressor.  ``kind``: rf, gbt, tree, enet, glm_gamma."""
    common = dict(featuresCol=features, labelCol=label, predictionCol=prediction)
    if "maxDepth" in params:
        if params["maxDepth"] > MAX_TREE_DEPTH:
            raise ValueError(f"maxDepth {params['maxDepth']}: Spark's trees have at most {MAX_TREE_DEPTH} levels")
        params["maxDepth"] = int(params["maxDepth"])
    if kind == "rf":
        est = RandomForestRegressor(**common, seed=params.pop("seed", 1), **params)
    elif kind == "gbt":
        est = GBTRegressor(**common, seed=params.pop("seed", 1), **params)
    elif kind == "tree":
        est = DecisionTreeRegressor(**common, seed=params.pop("seed", 1), **params)
    elif kind == "enet":
        est = LinearRegression(**common, **params)
    elif kind == "glm_gamma":
        est = GeneralizedLinearRegression(**common, family="gamma", link="log", **params)
    else:
        raise ValueError(kind)
    if weight:
        est.setWeightCol(weight)
    return est


# ---------------------------------------------------------------------------
# Target transforms
# ---------------------------------------------------------------------------
@dataclass
class TargetTransform:
    """``none`` | ``log`` | ``log-standardize`` (R: log, then centre/scale with the
    training mean/sd; inverse ``exp(y·sd + mean)``) | ``yeo-johnson`` (λ by ML)."""
    kind: str = "none"
    params: dict = field(default_factory=dict)

    def fit(self, train: DataFrame, labels: Sequence[str]) -> TargetTransform:
        if self.kind == "log-standardize":
            row = train.agg(*[F.avg(F.log(c)).alias(f"m_{c}") for c in labels],
                            *[F.stddev_samp(F.log(c)).alias(f"s_{c}") for c in labels]).first()
            self.params = {c: (float(row[f"m_{c}"]), float(row[f"s_{c}"] or 1.0)) for c in labels}
        elif self.kind == "yeo-johnson":
            pm = scale.fit_power(train, list(labels), "yeo-johnson", standardize=True)
            self.params = {"model": pm}
        return self

    def describe(self) -> dict:
        """Kind and fitted parameters as plain values."""
        if self.kind != "yeo-johnson" or not self.params:
            return {"kind": self.kind, "params": self.params}
        pm = self.params["model"]
        return {"kind": self.kind, "params": {"method": pm.method, "lambdas": pm.lambdas, "standardize": pm.standardize}}

    @classmethod
    def restore(cls, about: dict) -> TargetTransform:
        p = about["params"]
        if about["kind"] == "yeo-johnson" and p:
            pm = scale.PowerModel(p["method"], p["lambdas"])
            pm.standardize = {c: tuple(v) for c, v in p["standardize"].items()}
            return cls(about["kind"], {"model": pm})
        return cls(about["kind"], {c: tuple(v) for c, v in p.items()})

    def forward(self, c: str) -> Column:
        x = F.col(c).cast("double")
        if self.kind == "none":
            return x
        if self.kind == "log":
            return F.log(x)
        if self.kind == "log-standardize":
            m, s = self.params[c]
            return (F.log(x) - F.lit(m)) / F.lit(s)
        pm = self.params["model"]
        e = pm._fwd(x, pm.lambdas[c])
        m, s = pm.standardize[c]
        return (e - F.lit(m)) / F.lit(s)

    def inverse(self, pred: Column, c: str) -> Column:
        if self.kind == "none":
            return pred
        if self.kind == "log":
            return F.exp(pred)
        if self.kind == "log-standardize":
            m, s = self.params[c]
            return F.exp(pred * F.lit(s) + F.lit(m))
        pm = self.params["model"]
        m, s = pm.standardize[c]
        return pm._inv(pred * F.lit(s) + F.lit(m), pm.lambdas[c])


# ---------------------------------------------------------------------------
# Interval model (M13, M15): one preprocessing fit, one regressor per label
# ---------------------------------------------------------------------------
@dataclass
class IntervalModel:
    pipeline: PipelineModel
    labels: tuple[str, ...]
    target: TargetTransform
    numeric: tuple[str, ...]

    def transform(self, df: DataFrame, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
        scored = self.pipeline.transform(cast_numeric(df, self.numeric))
        outs = [self.target.inverse(F.col(f"__p_{c}"), c).alias(OUT.get(c, f"pred_{c}")) for c in self.labels]
        return scored.select(F.col(key).alias("ID") if key != "ID" else key, *keep, *outs)

    def regressors(self) -> dict:
        n = len(self.labels)
        return dict(zip(self.labels, self.pipeline.stages[-n:]))

    def save(self, path: str) -> None:
        """Fitted stages, labels, numeric columns and target transform under ``path``."""
        self.pipeline.write().overwrite().save(f"{path}/stages")
        about = {"labels": self.labels, "numeric": self.numeric, "target": self.target.describe()}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def fit_interval_model(train: DataFrame, kind: str = "rf", labels: Sequence[str] = LABELS,
                       numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
                       target: str | TargetTransform = "none", weight: str | None = None,
                       impute: str = "median", scaler: str | None = None, params: dict | None = None,
                       per_label_params: dict[str, dict] | None = None) -> IntervalModel:
    """Fit preprocessing + one regressor per label as a single ``Pipeline``
    (the preprocessing is fitted once, on ``train`` only)."""
    tt = target if isinstance(target, TargetTransform) else TargetTransform(target)
    tt.fit(train, labels)
    data = cast_numeric(train, numeric).withColumns({f"__y_{c}": tt.forward(c) for c in labels})
    # preprocessing is fitted once on the training rows (two passes: imputer
    # statistics and level lists); the raw frame is kept for those passes only
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    prep = Pipeline(stages=preprocessing(numeric, categorical, impute=impute, scaler=scaler)).fit(data)
    keep = ["features", *[f"__y_{c}" for c in labels], *([weight] if weight else [])]
    # every tree level / solver iteration is a pass over the feature vectors:
    # keep them materialised (spills to disk at scale) instead of recomputing
    feats = prep.transform(data).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    feats.count()
    data.unpersist(blocking=True)

    def fit_one(c):
        p = dict(params or {})
        p.update((per_label_params or {}).get(c, {}))
        return estimator(kind, f"__y_{c}", prediction=f"__p_{c}", weight=weight, **p).fit(feats)

    # the labels' regressors are independent: fitted concurrently (driver
    # threads submitting Spark jobs), like CrossValidator(parallelism)
    with ThreadPoolExecutor(max(1, len(labels))) as ex:
        regs = list(ex.map(fit_one, labels))
    feats.unpersist(blocking=True)
    model = PipelineModel(stages=list(prep.stages) + regs)
    return IntervalModel(model, tuple(labels), tt, tuple(numeric))


def load_interval_model(path: str) -> IntervalModel:
    """The model that ``save`` wrote: predicts as it did, on the labels' own scale."""
    about = json.loads(SparkSession.active().read.text(f"{path}/about").first()[0])
    return IntervalModel(PipelineModel.load(f"{path}/stages"), tuple(about["labels"]),
                         TargetTransform.restore(about["target"]), tuple(about["numeric"]))


def with_truth(pred: DataFrame, truth: DataFrame, key: str = "id") -> DataFrame:
    return pred.join(truth.select(F.col(key).alias("ID"), *LABELS), "ID")


# ---------------------------------------------------------------------------
# Model inspection
# ---------------------------------------------------------------------------
def feature_importances(model: IntervalModel, sample: DataFrame) -> DataFrame:
    """Impurity importances per label joined to slot names from the vector
    metadata (names come from the schema of one transformed frame)."""
    prep = PipelineModel(stages=model.pipeline.stages[:-len(model.labels)])
    names = feature_names(prep.transform(cast_numeric(sample.limit(1), model.numeric)))
    rows = []
    for lab, reg in model.regressors().items():
        imp = reg.featureImportances.toArray()
        rows += [(lab, names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    return sample.sparkSession.createDataFrame(rows, "label string, feature string, importance double")


def forest_shape(model: IntervalModel, spark) -> DataFrame:
    """Average node count and depth of the trees of each fitted ensemble."""
    rows = []
    for lab, reg in model.regressors().items():
        trees = reg.trees
        rows.append((lab, len(trees), float(sum(t.numNodes for t in trees)) / len(trees),
                     float(sum(t.depth for t in trees)) / len(trees)))
    return spark.createDataFrame(rows, "label string, n_trees int, avg_nodes double, avg_depth double")


def coefficient_path(train: DataFrame, label: str, lambdas: Sequence[float], alpha: float = 1.0,
                     numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Elastic-net coefficients over a λ grid (standardised features), long form
    (lambda, term, estimate); the intercept is dropped as in the reference."""
    prep = Pipeline(stages=preprocessing(numeric, categorical, scaler="standard")).fit(cast_numeric(train, numeric))
    feats = prep.transform(cast_numeric(train, numeric)).select("features", F.col(label).cast("double").alias("y"))
    feats = feats.persist()
    names = feature_names(feats)
    rows = []
    for lam in lambdas:
        m = LinearRegression(labelCol="y", regParam=float(lam), elasticNetParam=alpha, standardization=False,
                             maxIter=200).fit(feats)
        rows += [(float(lam), names[i], float(b)) for i, b in enumerate(m.coefficients.toArray())]
    feats.unpersist(blocking=True)
    return train.sparkSession.createDataFrame(rows, "lambda double, term string, estimate double")


def ols_summary(train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """``lm(y ~ .)``: estimate, standard error, t and p per term, plus R²
    (normal-equation solver; complete rows only, like R's default na.omit)."""
    cols = list(numeric) + list(categorical)
    data = cast_numeric(train.na.drop(subset=cols + [label]), numeric)
    cats = list(categorical)
    # treatment coding with the alphabetically first level as baseline: index in
    # descending order so that dropLast removes that level (full rank with intercept)
    stages = []
    if cats:
        stages += [StringIndexer(inputCols=cats, outputCols=[f"{c}__x" for c in cats], stringOrderType="alphabetDesc"),
                   OneHotEncoder(inputCols=[f"{c}__x" for c in cats], outputCols=[f"{c}__o" for c in cats],
                                 dropLast=True)]
    stages.append(VectorAssembler(inputCols=list(numeric) + [f"{c}__o" for c in cats], outputCol="features"))
    prep = Pipeline(stages=stages).fit(data)
    feats = prep.transform(data)
    names = feature_names(feats)
    m = LinearRegression(labelCol=label, solver="normal").fit(feats)
    s = m.summary
    terms = names + ["(Intercept)"]
    est = list(m.coefficients.toArray()) + [m.intercept]
    rows = [(t, float(e), float(se), float(tv), float(p), float(s.r2))
            for t, e, se, tv, p in zip(terms, est, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return train.sparkSession.createDataFrame(rows, "term string, estimate double, std_error double, "
                                                    "t_value double, p_value double, r2 double")


# ---------------------------------------------------------------------------
# AdaBoost.R2 (M9)
# ---------------------------------------------------------------------------
def weighted_median(preds: Column, weights: Sequence[float]) -> Column:
    """Weighted median of an array of stage predictions (AdaBoost.R2 rule: the
    smallest prediction whose cumulative weight reaches half the total)."""
    pairs = F.array_sort(F.arrays_zip(preds.alias("p"), F.array(*[F.lit(float(w)) for w in weights]).alias("w")))
    half = 0.5 * float(sum(weights))
    acc = F.aggregate(pairs, F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("pick")),
                      lambda a, x: F.struct((a["cum"] + x["w"]).alias("cum"),
                                            F.when(a["pick"].isNull() & (a["cum"] + x["w"] >= F.lit(half)), x["p"])
                                            .otherwise(a["pick"]).alias("pick")))
    return acc["pick"]


@dataclass
class AdaBoostModel:
    prep: PipelineModel
    trees: list
    weights: list[float]
    numeric: tuple[str, ...]

    def transform(self, df: DataFrame, key: str = "id", out: str = "prediction") -> DataFrame:
        f = self.prep.transform(cast_numeric(df, self.numeric))
        for i, t in enumerate(self.trees):
            f = t.setPredictionCol(f"__s{i}").transform(f)
        preds = F.array(*[F.col(f"__s{i}") for i in range(len(self.trees))])
        return f.select(key, weighted_median(preds, self.weights).alias(out))


def fit_adaboost_r2(train: DataFrame, label: str, n_estimators: int = 10, max_depth: int = 3,
                    key: str = "id", numeric: Sequence[str] = NUMERIC,
                    categorical: Sequence[str] = CATEGORICAL) -> AdaBoostModel:
    """AdaBoost.R2 with linear loss.  Sample weights live in a column and are
    passed to a weighted tree (``weightCol``) instead of resampling; each round
    is a few distributed aggregates, and lineage is cut by a reliable checkpoint."""
    data = cast_numeric(train, numeric)
    prep = Pipeline(stages=preprocessing(numeric, categorical)).fit(data)
    cur = prep.transform(data).select(key, "features", F.col(label).cast("double").alias("y"))
    n = cur.count()
    cur = cut_lineage(cur.withColumn("w", F.lit(1.0 / n)))
    trees, betas = [], []
    for i in range(n_estimators):
        tree = DecisionTreeRegressor(labelCol="y", weightCol="w", maxDepth=max_depth, seed=i,
                                     predictionCol="p").fit(cur)
        scored = tree.transform(cur).withColumn("err", F.abs(F.col("y") - F.col("p")))
        emax = scored.agg(F.max("err")).first()[0] or 0.0
        if emax <= 0:
            trees.append(tree)
            betas.append(1e-10)
            break
        loss = F.col("err") / F.lit(emax)
        r = scored.agg((F.sum(F.col("w") * loss) / F.sum("w")).alias("l")).first()
        avg_loss = float(r["l"])
        if avg_loss >= 0.5:
            if not trees:
                trees.append(tree)
                betas.append(1e-10)
            break
        beta = avg_loss / (1.0 - avg_loss)
        trees.append(tree)
        betas.append(beta)
        upd = scored.withColumn("w", F.col("w") * F.pow(F.lit(beta), F.lit(1.0) - loss))
        tot = upd.agg(F.sum("w")).first()[0]
        cur = cut_lineage(upd.withColumn("w", F.col("w") / F.lit(tot)).select(key, "features", "y", "w"))
    weights = [math.log(1.0 / max(b, 1e-10)) for b in betas]
    return AdaBoostModel(prep, trees, weights, tuple(numeric))


# ---------------------------------------------------------------------------
# RBF kernel regression re-aimed as random Fourier features
# ---------------------------------------------------------------------------
@dataclass
class RFFModel:
    prep: PipelineModel
    W: list
    b: list
    linear: object
    numeric: tuple[str, ...]

    def features(self, df: DataFrame) -> DataFrame:
        W = np.asarray(self.W)
        b = np.asarray(self.b)
        scale_ = math.sqrt(2.0 / W.shape[0])

        @pandas_udf("array<double>")
        def rff(x: pd.Series) -> pd.Series:  # one Arrow batch → one matrix product
            X = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, W.shape[1]))
            Z = scale_ * np.cos(X @ W.T + b)
            return pd.Series(list(Z))

        f = self.prep.transform(cast_numeric(df, self.numeric))
        return f.withColumn("rff", array_to_vector(rff(vector_to_array(F.col("features")))))

    def transform(self, df: DataFrame, key: str = "id", out: str = "prediction") -> DataFrame:
        return self.linear.setPredictionCol(out).transform(self.features(df)).select(key, out)


def fit_rff_features(data: DataFrame, gamma: float, n_components: int, seed: int, numeric: Sequence[str] = NUMERIC,
                     categorical: Sequence[str] = CATEGORICAL) -> RFFModel:
    """cos(Wx+b) features (W ~ N(0, 2γ), b ~ U[0, 2π), seeded, broadcast with the
    closure: n_components × n_features doubles); no regression on them yet."""
    data = cast_numeric(data, numeric)
    prep = Pipeline(stages=preprocessing(numeric, categorical, scaler="standard")).fit(data)
    dim = len(feature_names(prep.transform(data.limit(1))))
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, dim))
    b = rng.uniform(0.0, 2 * math.pi, size=n_components)
    return RFFModel(prep, W.tolist(), b.tolist(), None, tuple(numeric))


def fit_rff_regression(train: DataFrame, label: str, gamma: float = 0.1, n_components: int = 200,
                       reg: float = 0.01, seed: int = 0, numeric: Sequence[str] = NUMERIC,
                       categorical: Sequence[str] = CATEGORICAL) -> RFFModel:
    """Random Fourier features + ridge regression."""
    model = fit_rff_features(train, gamma, n_components, seed, numeric, categorical)
    feats = model.features(train).select("rff", F.col(label).cast("double").alias("y"))
    model.linear = LinearRegression(featuresCol="rff", labelCol="y", regParam=reg, elasticNetParam=0.0).fit(feats)
    return model


def polynomial_features(df: DataFrame, cols: Sequence[str], degree: int = 2) -> DataFrame:
    """Polynomial expansion (F16) of the numeric columns; missing values count as
    the column's median, so every row is kept."""
    from .impute import fit_median

    full = fit_median(df, cols).transform(df)
    full = full.withColumns({f"__x{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(cols)})
    v = VectorAssembler(inputCols=[f"__x{i}" for i in range(len(cols))], outputCol="__v").transform(full)
    v = v.drop(*[f"__x{i}" for i in range(len(cols))])
    return PolynomialExpansion(degree=degree, inputCol="__v", outputCol="poly").transform(v).drop("__v")


def pca_features(train: DataFrame, df: DataFrame, k: int = 15, keep_original: bool = False,
                 numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
                 out: str = "features_pca") -> DataFrame:
    """Dimensionality reduction step (E10): standardised preprocessing + PCA
    fitted on ``train``; the components replace the features, or are appended
    to them when ``keep_original``.  The k × d loadings are the only fitted
    state (d = assembled feature width)."""
    from pyspark.ml.feature import PCA

    prep = Pipeline(stages=preprocessing(numeric, categorical, scaler="standard")).fit(cast_numeric(train, numeric))
    pca = PCA(k=k, inputCol="features", outputCol="__pca").fit(prep.transform(cast_numeric(train, numeric)))
    scored = pca.transform(prep.transform(cast_numeric(df, numeric)))
    cols = ["features", "__pca"] if keep_original else ["__pca"]
    return VectorAssembler(inputCols=cols, outputCol=out).transform(scored).drop("__pca")
