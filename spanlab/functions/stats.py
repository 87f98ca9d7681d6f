"""Exact distributed order statistics.

Spark's ``percentile`` keeps every distinct value of a group in one buffer and
``percentile_approx`` is approximate.  The functions here give the exact
``quantile_cont`` (numpy "linear") answer with bounded memory at every size:
values are counted per group, a sketch of the distinct values cuts each group
into buckets, and only the buckets that hold a wanted order statistic are
ranked, each in a window of its own.  All columns (as groups) and all
probabilities share the same fixed number of passes; what reaches the driver is
one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256


def exact_quantiles_many(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                         buckets: int = BUCKETS) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles (numpy / DuckDB ``quantile_cont``) of the
    non-null values of several columns; ``None`` for a column without values."""
    if not cols:
        return {}
    cols = list(cols)
    names = [f"c{i}" for i in range(len(cols))]
    long = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)]).unpivot([], names, "__col", "__val")
    rows = grouped_exact_quantiles(long, "__val", ["__col"], probs, buckets).collect()  # one row per column
    got = {r["__col"]: [r[f"q{i}"] for i in range(len(probs))] for r in rows}
    return {c: got.get(n, [None for _ in probs]) for c, n in zip(cols, names)}


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    return exact_quantiles_many(df, [col], probs)[col]


def grouped_exact_quantiles(df: DataFrame, col: str, by: Sequence[str], probs: Sequence[float],
                            buckets: int = BUCKETS, accuracy: int = 10_000) -> DataFrame:
    """Exact linear-interpolated quantiles per group without holding a group in
    one task (Spark's ``percentile`` merges every distinct value of a group in
    one buffer, so a group holding a third of the rows would sit in one task).

    1. (group, value) counts — partial aggregation, spread by value hash.
    2. Per group, ``buckets`` - 1 approximate boundaries over its distinct values
       (bounded-memory sketch) split the values into buckets.
    3. Bucket counts → running offsets per group (a window over ≤ buckets rows).
    4. Only the buckets holding a needed order statistic are ranked, each in its
       own window partition (group, bucket) of about 1/buckets of the group.
    The group columns are one struct until the end: unlike the columns, it joins where they are NULL.
    Output: ``by`` columns, ``n`` (non-null count) and ``q0 … q{m-1}``."""
    probs = [float(p) for p in probs]
    v = F.col("__x")
    df = df.select(F.struct(*by).alias("__g"), F.col(col).cast("double").alias("__x"))
    by = ["__g"]
    counts = df.filter(v.isNotNull()).groupBy(*by, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    grid = [i / buckets for i in range(1, buckets)]
    bounds = counts.groupBy(*by).agg(F.percentile_approx("__v", grid, accuracy).alias("__bd"),
                                     F.sum("__c").alias("n"))
    b = counts.join(bounds, by).withColumn(
        "__b", F.size(F.filter(F.array_distinct(F.col("__bd")), lambda x: x < F.col("__v"))))
    per = b.groupBy(*by, "__b", "n").agg(F.sum("__c").alias("__bc"))
    wo = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__off", F.coalesce(F.sum("__bc").over(wo), F.lit(0)))
    # needed 0-based ranks per group: floor and ceil of (n - 1) p for every p
    need = per.select(*by, "__b", "__off", "__bc", "n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("qi"), F.lit(j).alias("side"),
                 (F.floor((F.col("n") - 1) * F.lit(p)) + F.lit(j)).cast("long").alias("r0"))
        for i, p in enumerate(probs) for j in (0, 1)])).alias("z")).select(
        *by, "__b", "__off", "__bc", "n", "z.qi", "z.side",
        F.least(F.col("z.r0"), F.col("n") - 1).alias("rk"))
    need = need.filter((F.col("rk") >= F.col("__off")) & (F.col("rk") < F.col("__off") + F.col("__bc")))
    wanted = need.select(*by, "__b").distinct()
    wv = Window.partitionBy(*by, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (b.join(wanted, by + ["__b"], "left_semi").withColumn("__cum", F.sum("__c").over(wv))
              .select(*by, "__b", "__v", "__cum", "__c"))
    # value of rank rk: the row with cum - c <= rk - off < cum
    hit = need.join(ranked, by + ["__b"]).filter(
        (F.col("__cum") - F.col("__c") <= F.col("rk") - F.col("__off")) & (F.col("rk") - F.col("__off") < F.col("__cum")))
    sides = hit.groupBy(*by, "n", "qi").agg(
        F.max(F.when(F.col("side") == 0, F.col("__v"))).alias("lo"),
        F.max(F.when(F.col("side") == 1, F.col("__v"))).alias("hi"))
    p_arr = F.array(*[F.lit(p) for p in probs])
    frac = (F.col("n") - 1) * p_arr[F.col("qi")] - F.floor((F.col("n") - 1) * p_arr[F.col("qi")])
    qv = sides.withColumn("q", F.col("lo") + frac * (F.col("hi") - F.col("lo")))
    out = qv.groupBy(*by, "n").pivot("qi", list(range(len(probs)))).agg(F.first("q"))
    return out.select("__g.*", F.col("n").cast("long").alias("n"),
                      *[F.col(str(i)).alias(f"q{i}") for i in range(len(probs))])
