"""Joins, set operations, ordering and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import ordered_rank


def bind_by_id(*dfs: DataFrame, key: str = "id") -> DataFrame:
    """Column-bind by key (the positional ``concat(axis=1)`` made explicit)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.join(d, on=key, how="inner")
    return out


def inner_join(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    return left.join(right, on=key, how="inner")


def semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on=on, how="left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on=on, how="left_anti")


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def summarize_configs(results: DataFrame, config: str = "config_id", value: str = "value") -> DataFrame:
    """Mean and population sd of a metric per configuration (partial aggregation)."""
    return results.groupBy(config).agg(F.avg(value).alias("mean_value"), F.stddev_pop(value).alias("sd_value"),
                                       F.count(F.lit(1)).alias("n_folds"))


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """``orderBy(...).limit(k)`` — planned as TakeOrderedAndProject (per-task top-k
    then a k-row merge), never a full sort to one task."""
    return df.orderBy(*order).limit(k)


def select_best(summary: DataFrame, config: str = "config_id", metric: str = "mean_value",
                larger_is_better: bool = False) -> DataFrame:
    """argmin / argmax with a deterministic tie-break on the config key."""
    m = F.col(metric)
    key = F.struct((-m if larger_is_better else m).alias("m"), F.col(config).alias("c"))
    return summary.agg(F.min_by(F.col(config), key).alias(config), F.min(key)["m"].alias("__m")).select(
        config, (F.col("__m") * (-1 if larger_is_better else 1)).alias(metric))


def nearest(summary: DataFrame, target: float, config: str = "config_id", metric: str = "mean_value") -> DataFrame:
    """Row whose metric is nearest to ``target`` (``which.min(abs(Δ))``)."""
    d = F.abs(F.col(metric) - F.lit(target))
    key = F.struct(d.alias("d"), F.col(config).alias("c"))
    return summary.agg(F.min_by(F.col(config), key).alias(config), F.min_by(F.col(metric), key).alias(metric))


def row_ordinal(df: DataFrame, key: str = "id", out: str = "ordinal") -> DataFrame:
    return ordered_rank(df, key, out=out)
