"""Exact global ranks without a single-partition window.

A window with no ``partitionBy`` moves every row into one task.  Both helpers
here split the order into buckets (hash prefixes or ranges), count each bucket,
turn the counts into offsets (one row per bucket) and rank inside each bucket
with a partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .columns import hash_key


def hash_ranked(df: DataFrame, key: str = "id", seed: int | str | Column = 0, out: str = "rank",
                digits: int = 4, by: Sequence[str] = ()) -> DataFrame:
    """1-based rank of each row in the order (md5(seed:key), key), within each
    group of ``by`` (then ``seed`` may be a column of the group).

    ``digits`` hex digits of the hash form the buckets (16**digits of them, about
    equal in size because the hash is uniform over distinct keys)."""
    h, b, by = "__h", "__b", list(by)
    with_h = df.withColumn(h, hash_key(key, seed)).withColumn(b, F.substring(F.col(h), 1, digits))
    first = Window.partitionBy(*by) if by else Window.partitionBy()  # over at most 16**digits rows of a group
    first = first.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offs = with_h.groupBy(*by, b).agg(F.count(F.lit(1)).alias("__n")).select(
        *by, b, F.coalesce(F.sum("__n").over(first), F.lit(0)).alias("__offset"))
    w = Window.partitionBy(*by, b).orderBy(h, key)
    return (with_h.join(offs, on=[*by, b], how="inner")
            .withColumn(out, F.col("__offset") + F.row_number().over(w))
            .drop(h, b, "__offset"))


def value_ranks(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` (any orderable type) with ``n_lt`` (rows
    strictly smaller) and ``n_eq`` (rows equal).  Hot values are collapsed by the
    grouped count first (partial aggregation), so a value that holds a third of
    the rows is a single row here.  The counts are range-sorted; a value's rows
    before it are those of earlier partitions (one sum per partition) and those
    before it in its own."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_eq")).filter(F.col(col).isNotNull())
    s = cut_lineage(counts.orderBy(col).withColumn("__m", F.monotonically_increasing_id()))
    s = s.withColumn("__p", F.shiftright("__m", 33))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offs = s.groupBy("__p").agg(F.sum("n_eq").alias("__n")).select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    own = Window.partitionBy("__p").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    return (s.withColumn("__i", F.coalesce(F.sum("n_eq").over(own), F.lit(0))).join(F.broadcast(offs), on="__p", how="inner")
            .select(col, (F.col("__o") + F.col("__i")).alias("n_lt"), "n_eq"))


def ordered_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """1-based position of each row in the order of a *unique* column."""
    vr = value_ranks(df, col).select(col, (F.col("n_lt") + 1).alias(out))
    return df.join(vr, on=col, how="inner")
