"""Metrics, residual tables and interval post-processing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_mae(df: DataFrame, truth: Sequence[str] = ("min_price", "max_price"),
                 pred: Sequence[str] = ("MIN", "MAX")) -> DataFrame:
    """One aggregate: MAE of each bound and their sum (the reference's headline metric)."""
    lo = F.avg(F.abs(F.col(truth[0]) - F.col(pred[0])))
    hi = F.avg(F.abs(F.col(truth[1]) - F.col(pred[1])))
    return df.agg(lo.alias("mae_min"), hi.alias("mae_max")).withColumn(
        "mae_total", F.col("mae_min") + F.col("mae_max"))


def interval_mae_flat(df: DataFrame, truth: Sequence[str] = ("min_price", "max_price"),
                      pred: Sequence[str] = ("MIN", "MAX")) -> DataFrame:
    """Mean error of the stacked (min, max) values, doubled — equals ``mae_total``.
    The two errors are summed and counted apart: a row that lacks one of them
    still counts for the other."""
    parts = [F.abs(F.col(t) - F.col(p)) for t, p in zip(truth, pred)]
    lo, hi = (F.try_divide(F.sum(e), F.count(e)) for e in parts)
    return df.agg((lo + hi).alias("mae_flat"))


def mae(df: DataFrame, truth: str, pred: str) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(truth) - F.col(pred))).alias("mae"))


def regression_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """MAE, RMSE and traditional R² = 1 - SSE/SST in one pass (SST from moments)."""
    e = F.col(truth) - F.col(pred)
    y = F.col(truth)
    agg = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sum(e * e).alias("sse"),
                 F.var_pop(y).alias("vy"), F.count(y).alias("n"))
    return agg.select("mae", F.sqrt("mse").alias("rmse"),
                      (F.lit(1.0) - F.try_divide("sse", F.col("vy") * F.col("n"))).alias("rsq"))


def residuals(df: DataFrame, truth: str, pred: str, order: int = 1, key: str = "id") -> DataFrame:
    r = F.col(truth) - F.col(pred)
    return df.select(key, F.col(truth).alias("actual"), F.col(pred).alias("fitted"),
                     (F.pow(r, order) if order != 1 else r).alias("residual"))


def fitted_actual(df: DataFrame, truth: str, pred: str, log10: bool = False, key: str = "id") -> DataFrame:
    t = F.log10(F.col(truth)) if log10 else F.col(truth)
    p = F.log10(F.col(pred)) if log10 else F.col(pred)
    return df.select(key, t.alias("actual"), p.alias("fitted"))


def spread_series(df: DataFrame, truth: Sequence[str] = ("min_price", "max_price"),
                  pred: Sequence[str] = ("MIN", "MAX"), key: str = "id") -> DataFrame:
    return df.select(key, (F.col(truth[1]) - F.col(truth[0])).alias("true_spread"),
                     (F.col(pred[1]) - F.col(pred[0])).alias("pred_spread"))


def inverted_intervals(df: DataFrame, lo: str = "MIN", hi: str = "MAX") -> DataFrame:
    return df.filter(F.col(lo) > F.col(hi))


def repair_intervals(df: DataFrame, lo: str = "MIN", hi: str = "MAX") -> DataFrame:
    """Swap bounds so that lo <= hi (idempotent); a row with a NULL bound is kept
    as it is (``least``/``greatest`` alone would copy the other bound)."""
    swap = F.col(lo) > F.col(hi)
    return df.withColumns({lo: F.when(swap, F.col(hi)).otherwise(F.col(lo)),
                           hi: F.when(swap, F.col(lo)).otherwise(F.col(hi))})


def average_predictions(*dfs: DataFrame, key: str = "id", cols: Sequence[str] = ("MIN", "MAX")) -> DataFrame:
    """Equal-weight ensemble: union in long form, one grouped average on the key."""
    long = None
    for i, d in enumerate(dfs):
        part = d.select(key, *cols).withColumn("__src", F.lit(i))
        long = part if long is None else long.unionByName(part)
    return long.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def compare_distributions(frames: Mapping[str, DataFrame], col: str, bins: int = 30) -> DataFrame:
    """Fixed-width histogram of ``col`` per source on a common range (one pass per
    source for the range, one grouped count over the union)."""
    from .profile import fixed_bins  # local import to avoid cycles

    tagged = None
    for name, d in frames.items():
        part = d.select(F.col(col).cast("double").alias("v")).withColumn("source", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    return fixed_bins(tagged, "v", bins=bins, by=["source"])


class IntervalMAEEvaluator(Evaluator):
    """``pyspark.ml`` evaluator for the MAE of one label or, with comma-separated
    columns, the sum of the labels' MAEs (smaller is better)."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column",
                          typeConverter=TypeConverters.toString)

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        labels = self.getOrDefault(self.labelCol).split(",")
        preds = self.getOrDefault(self.predictionCol).split(",")
        row = dataset.agg(*[F.avg(F.abs(F.col(y) - F.col(p))) for y, p in zip(labels, preds, strict=True)]).first()
        return float(sum(v if v is not None else float("nan") for v in row))

    def isLargerBetter(self) -> bool:
        return False
