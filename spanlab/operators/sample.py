"""Splits, folds, weights and oversampling.

All assignments are functions of a hash of (seed, key), so they are re-runnable
and independent of partitioning; exact sizes come from the distributed rank
helper (``functions.ranking``), never from a single-task window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_key
from ..functions.ranking import hash_ranked, ordered_rank


def hex_threshold(frac: float, digits: int = 8) -> str:
    """Hex string t such that md5 prefix < t holds for a ``frac`` share of keys."""
    return format(min(int(frac * 16 ** digits), 16 ** digits - 1), f"0{digits}x")


def split_hash(df: DataFrame, frac: float = 0.75, key: str = "id", seed: int | str = 0,
               labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Fast mode: a row is in the first part iff its hash prefix is below a threshold."""
    cond = F.substring(hash_key(key, seed), 1, 8) < F.lit(hex_threshold(frac))
    return df.withColumn("split", F.when(cond, labels[0]).otherwise(labels[1]))


def _n(df: DataFrame) -> int:
    return df.count()


def split_exact(df: DataFrame, frac: float = 0.75, key: str = "id", seed: int | str = 0,
                labels: tuple[str, str] = ("train", "test"), n: int | None = None) -> DataFrame:
    """Exactly round(frac·n) rows (pandas ``sample(frac)``) in the first part."""
    n = _n(df) if n is None else n
    m = int(round(frac * n))
    r = hash_ranked(df, key, seed, out="__rank")
    return r.withColumn("split", F.when(F.col("__rank") <= m, labels[0]).otherwise(labels[1])).drop("__rank")


def split_three_way(df: DataFrame, test: float = 0.25, val: float = 0.3, key: str = "id",
                    seed: int | str = 0) -> DataFrame:
    """Nested split like two ``train_test_split`` calls: ceil(test·n) test rows,
    then ceil(val·rest) validation rows, the remainder train."""
    n = _n(df)
    t = int(math.ceil(test * n))
    v = int(math.ceil(val * (n - t)))
    r = hash_ranked(df, key, seed, out="__rank")
    return r.withColumn("split", F.when(F.col("__rank") <= t, "test")
                        .when(F.col("__rank") <= t + v, "val").otherwise("train")).drop("__rank")


def repeated_splits(df: DataFrame, seeds: Sequence[int] = (37, 38, 39, 40, 41), test: float = 0.2,
                    key: str = "id") -> DataFrame:
    """One exact split per seed, long form (seed, key, split); all seeds in one pass."""
    t = int(math.ceil(test * _n(df)))
    each = df.select(key, F.explode(F.array(*[F.lit(int(s)) for s in seeds])).alias("seed"))
    r = hash_ranked(each, key, F.col("seed"), out="__rank", by=["seed"])
    return r.select("seed", key, F.when(F.col("__rank") <= t, "test").otherwise("train").alias("split"))


def _fold_from_rank(rank0, n: int, k: int):
    q, r = divmod(n, k)
    big = r * (q + 1)
    if q == 0:
        return rank0
    return F.when(rank0 < big, F.floor(rank0 / (q + 1))).otherwise(
        F.lit(r) + F.floor((rank0 - big) / q)).cast("int")


def with_folds(df: DataFrame, k: int = 5, key: str = "id", shuffle: bool = False, seed: int | str = 0,
               out: str = "fold") -> DataFrame:
    """k folds, larger folds first (``ntile`` sizes): contiguous in key order, or in
    hash order when ``shuffle``."""
    n = _n(df)
    r = hash_ranked(df, key, seed, out="__rank") if shuffle else ordered_rank(df, key, out="__rank")
    return r.withColumn(out, _fold_from_rank(F.col("__rank") - 1, n, k)).drop("__rank")


def with_weights(df: DataFrame, col: str, order: int = 1, out: str = "weight") -> DataFrame:
    """p^order / Σ p^order (order 0 → 1/n); the sum is a scalar aggregate, joined
    back as a literal — no global window."""
    if order == 0:
        n = df.count()
        return df.withColumn(out, F.lit(1.0 / max(1, n)))
    total = df.agg(F.sum(F.pow(F.col(col), order))).first()[0]
    return df.withColumn(out, F.pow(F.col(col), order) / F.lit(total))


# The reference's oversampling bands on max_price (inclusive bounds;
# None = open) and the number of extra copies per band; overlapping bands add up.
REFERENCE_BANDS = ((2000.0, None, 10, True), (2200.0, 2400.0, 10, False), (2600.0, 3000.0, 10, False),
                   (1200.0, 2000.0, 1, False), (1000.0, 1200.0, 2, False))


def oversample(df: DataFrame, col: str = "max_price", bands=REFERENCE_BANDS, out: str = "copy") -> DataFrame:
    """Each row repeated 1 + Σ extra(bands containing it) times; ``copy`` numbers
    the repeats (0 = original).  Row-local ``explode``: no shuffle."""
    extra = F.lit(0)
    for lo, hi, k, strict_lo in bands:
        c = F.col(col)
        cond = (c > lo) if strict_lo else (c >= lo)
        if hi is not None:
            cond = cond & (c <= hi)
        extra = extra + F.when(cond, k).otherwise(0)
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), extra)))


def learning_curve_sizes(df: DataFrame, fractions: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0),
                         key: str = "id", seed: int | str = 0) -> DataFrame:
    """Nested subsets: a row belongs to subset i iff its hash rank <= int(f_i·n);
    returns the smallest subset index containing each row."""
    n = _n(df)
    sizes = [int(f * n) for f in fractions]
    r = hash_ranked(df, key, seed, out="__rank")
    expr = None
    for i, m in enumerate(sizes):
        cond = F.col("__rank") <= m
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return r.withColumn("subset", expr).drop("__rank")


def split(df: DataFrame, frac: float = 0.75, key: str = "id", seed: int | str = 0, exact: bool = False,
          labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Two-way split column: exact size (distributed rank) or hash threshold."""
    if exact:
        return split_exact(df, frac, key, seed, labels)
    return split_hash(df, frac, key, seed, labels)
