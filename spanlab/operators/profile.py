"""Profiling and distribution tables.

Shape rule: all statistics of a frame in as few scans as possible — one wide
aggregate then ``unpivot`` — and plot *data* (binned counts, quantiles),
never raw points shipped to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import inverse_normal_sql
from ..functions.ranking import value_ranks
from ..functions.stats import exact_quantiles, exact_quantiles_many, grouped_exact_quantiles
from .clean import numeric_columns


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))


def group_count(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def _rows_df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact), max per numeric column."""
    cols = list(cols or numeric_columns(df))
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in cols
                   for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp),
                                ("min", F.min), ("max", F.max))]).first()
    qs = exact_quantiles_many(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, int(row[f"count_{c}"]), row[f"mean_{c}"], row[f"std_{c}"], row[f"min_{c}"], qs[c][0], qs[c][1],
             qs[c][2], row[f"max_{c}"]) for c in cols]
    return _rows_df(df.sparkSession, rows, "column string, count long, mean double, std double, min double, "
                                           "q25 double, q50 double, q75 double, max double")


def top_level(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null level (ties → smallest) and its count, one row."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("freq"))
    key = F.struct((-F.col("freq")).alias("nf"), F.col(col).alias("v"))
    return counts.agg(F.min_by(F.col(col), key).alias("top"), F.max("freq").alias("freq"),
                      F.count(F.lit(1)).alias("unique"))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top, freq per string column."""
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    out = None
    for c in cols:
        part = top_level(df, c).select(F.lit(c).alias("column"), F.lit(int(counts[c])).cast("long").alias("count"),
                                       F.col("unique").cast("long").alias("unique"),
                                       F.col("top").cast("string").alias("top"),
                                       F.col("freq").cast("long").alias("freq"))
        out = part if out is None else out.unionByName(part)
    return out


def frame_info(df: DataFrame) -> DataFrame:
    """Column, Spark type, non-null count, row count (one aggregate)."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    rows = [(c, df.schema[c].dataType.simpleString(), int(row[c]), int(row["__n"])) for c in df.columns]
    return _rows_df(df.sparkSession, rows, "column string, dtype string, non_null long, n_rows long")


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete), long form, one pass."""
    cols = list(cols or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    def corr(a, b):  # NULL for a constant column (``corr`` divides by its zero spread)
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    if not pairs:
        return _rows_df(df.sparkSession, [(c, c, 1.0) for c in cols], "var_a string, var_b string, corr double")
    row = df.agg(*[corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)]).first()
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append((a, b, row[f"{i}"]))
        rows.append((b, a, row[f"{i}"]))
    rows += [(c, c, 1.0) for c in cols]
    return _rows_df(df.sparkSession, rows, "var_a string, var_b string, corr double")


def corr_select(df: DataFrame, targets: Sequence[str], threshold: float = 0.5,
                cols: Sequence[str] | None = None) -> DataFrame:
    cm = corr_matrix(df, cols)
    return cm.filter(F.col("var_b").isin(*targets) & ~F.col("var_a").isin(*targets)
                     & (F.abs(F.col("corr")) > threshold))


def fixed_bins(df: DataFrame, col: str, bins: int = 30, by: Sequence[str] = (),
               lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Fixed-width histogram (empty bins included) of ``col``, optionally per group.

    Range from one min/max aggregate; bin index is arithmetic; counts are a
    grouped aggregate; the empty-bin grid is ``sequence`` exploded per group."""
    by = list(by)
    x = F.col(col).cast("double")
    if lo is None or hi is None:
        r = df.agg(F.min(x), F.max(x)).first()
        lo, hi = (r[0] if lo is None else lo), (r[1] if hi is None else hi)
    if lo is None:
        return df.limit(0).select(*by, F.lit(0).alias("bin"), F.lit(0.0).alias("lower"), F.lit(0.0).alias("upper"), F.lit(0).cast("long").alias("n"))
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.filter(x.isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = grid.join(counts, on=[*by, "bin"], how="left").fillna(0, subset=["n"])
    return out.select(*by, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), F.col("n").cast("long").alias("n"))


def auto_bin_count(df: DataFrame, col: str, max_bins: int = 100_000) -> tuple[int, float, float]:
    """numpy ``bins='auto'``: the smaller of the Sturges and Freedman–Diaconis widths.
    More than ``max_bins`` (a far outlier over a narrow middle) are refused."""
    import math
    r = df.agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if not r["n"]:
        return 0, 0.0, 0.0
    n, lo, hi = r["n"], float(r["lo"]), float(r["hi"])
    if hi == lo:
        return 1, lo, hi
    q25, q75 = exact_quantiles(df, col, [0.25, 0.75])
    sturges = (hi - lo) / (math.log2(n) + 1.0)
    fd = 2.0 * (q75 - q25) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    bins = int(math.ceil((hi - lo) / width))
    if bins > max_bins:
        raise ValueError(f"{col}: {bins} bins of width {width:g} from {lo:g} to {hi:g}; more than max_bins = {max_bins}: clip the column or give a bin count")
    return bins, lo, hi


def histogram_auto(df: DataFrame, col: str) -> DataFrame:
    bins, lo, hi = auto_bin_count(df, col)
    if not bins:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long")
    return fixed_bins(df, col, bins=bins, lo=lo, hi=hi)


def hist_density(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    h = fixed_bins(df, col, bins)
    n = df.filter(F.col(col).isNotNull()).count()
    return h.withColumn("density", F.col("n") / (F.lit(float(n)) * (F.col("upper") - F.col("lower"))))


def bandwidth_nrd0(df: DataFrame, col: str) -> float:
    r = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("sd")).first()
    if not r["n"]:
        return 1.0
    q25, q75 = exact_quantiles(df, col, [0.25, 0.75])
    lo = min(r["sd"] or 0.0, (q75 - q25) / 1.34)
    if lo <= 0:
        lo = r["sd"] or 1.0
    return 0.9 * lo * r["n"] ** (-0.2)


def kde_binned(df: DataFrame, col: str, bins: int = 30, grid: int = 64) -> DataFrame:
    """Gaussian kernel density on a fixed grid, evaluated from binned counts
    (bins × grid work, independent of the row count)."""
    import math
    h = fixed_bins(df, col, bins)
    n = df.filter(F.col(col).isNotNull()).count()
    bw = bandwidth_nrd0(df, col)
    r = h.agg(F.min("lower"), F.max("upper")).first()
    if not n:
        return df.sparkSession.createDataFrame([], "g int, x double, density double")
    lo, hi = r[0], r[1]
    step = (hi - lo) / (grid - 1)
    g = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g")
    centre = (F.col("lower") + F.col("upper")) / 2.0
    pts = h.select(centre.alias("c"), "n", g).withColumn("x", F.lit(lo) + F.col("g") * F.lit(step))
    z = (F.col("x") - F.col("c")) / F.lit(bw)
    contrib = F.col("n") * F.exp(-0.5 * z * z) / F.lit(math.sqrt(2 * math.pi))
    return pts.groupBy("g", "x").agg((F.sum(contrib) / F.lit(n * bw)).alias("density"))


def boxplot_stats(df: DataFrame, col: str, whisker: float = 1.5) -> DataFrame:
    x = F.col(col).cast("double")
    q1, med, q3 = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    iqr = q3 - q1 if q1 is not None else None
    lf, hf = (q1 - whisker * iqr, q3 + whisker * iqr) if q1 is not None else (None, None)

    def lit(v):  # no values: NULLs
        return F.lit(v).cast("double")

    lf, hf = lit(lf), lit(hf)
    return df.agg(lit(q1).alias("q1"), lit(med).alias("median"), lit(q3).alias("q3"),
                  lit(iqr).alias("iqr"), F.min(F.when(x >= lf, x)).alias("whisker_lo"),
                  F.max(F.when(x <= hf, x)).alias("whisker_hi"),
                  F.count(F.when((x < lf) | (x > hf), 1)).alias("n_outliers"))


def letter_value_probs(depth: int = 4) -> list[float]:
    probs = [0.5]
    for d in range(2, depth + 1):
        p = 0.5 ** d
        probs += [p, 1 - p]
    return probs


def grouped_quantiles(df: DataFrame, col: str, by: Sequence[str], probs: Sequence[float],
                      accuracy: int | None = None) -> DataFrame:
    """Per-group quantiles: exact by distributed ranks (linear interpolation) or,
    with ``accuracy``, the bounded-memory sketch.  Groups without values have
    NULL quantiles."""
    x = F.col(col).cast("double")
    if not accuracy:
        exact = grouped_exact_quantiles(df, col, by, probs)
        groups = df.select(*by).distinct()
        same = [groups[c].eqNullSafe(exact[c]) for c in by]
        return groups.join(exact, same, "left").select(
            *[groups[c] for c in by], F.coalesce("n", F.lit(0)).cast("long").alias("n"), *[f"q{i}" for i in range(len(probs))])
    q = F.percentile_approx(x, list(probs), accuracy)
    return df.groupBy(*by).agg(F.count(x).alias("n"), q.alias("__q")).select(
        *by, "n", *[F.col("__q")[i].alias(f"q{i}") for i in range(len(probs))])


def letter_values(df: DataFrame, col: str, by: Sequence[str], depth: int = 4) -> DataFrame:
    probs = letter_value_probs(depth)
    g = grouped_quantiles(df, col, by, probs)
    long = g.select(*by, "n", F.explode(F.arrays_zip(
        F.array(*[F.lit(p) for p in probs]).alias("p"),
        F.array(*[F.col(f"q{i}") for i in range(len(probs))]).alias("v"))).alias("z"))
    return long.select(*by, "n", F.col("z.p").alias("prob"), F.col("z.v").alias("value"))


def grouped_distribution(df: DataFrame, y: str, x: str, hue: str) -> DataFrame:
    g = grouped_quantiles(df, y, [x, hue], [0.25, 0.5, 0.75])
    mm = df.groupBy(F.col(x).alias("__x"), F.col(hue).alias("__h")).agg(F.min(y).cast("double").alias("min"), F.max(y).cast("double").alias("max"))
    return g.join(mm, F.col(x).eqNullSafe(F.col("__x")) & F.col(hue).eqNullSafe(F.col("__h"))).select(x, hue, "n", F.col("q0").alias("q25"), F.col("q1").alias("q50"),
                                       F.col("q2").alias("q75"), "min", "max")


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """2-D binned counts for every pair of numeric columns (long form)."""
    cols = list(cols)
    r = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    idx = {}
    for c in cols:
        lo, hi = float(r[f"lo_{c}"] or 0), float(r[f"hi_{c}"] or 0)  # no value: no bin
        w = (hi - lo) / bins if hi > lo else 1.0
        # least() skips NULLs, so a NULL value must stay NULL explicitly
        idx[c] = F.when(F.col(c).isNotNull(), F.least(
            F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(bins - 1)))
    pairs = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), idx[a].alias("bin_a"), idx[b].alias("bin_b"))
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    e = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter(
        F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull())
    return e.groupBy("var_a", "var_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("n"))


QQ_PIECE = 10_000


def qq_points(df: DataFrame, col: str) -> DataFrame:
    """Normal Q-Q data: i-th order statistic vs Φ⁻¹ of Filliben's median (scipy
    ``probplot``).  Ranks from the distributed value-rank helper; ties expand
    back to one row per original row."""
    vr = value_ranks(df, col)
    n = df.filter(F.col(col).isNotNull()).count()
    # a hot value expands in pieces of at most QQ_PIECE rows, dealt to all tasks
    piece = F.explode(F.sequence(F.col("n_lt") + 1, F.col("n_lt") + F.col("n_eq"), F.lit(QQ_PIECE).cast("long")))
    rows = vr.select(F.col(col).cast("double").alias("sample"), (F.col("n_lt") + F.col("n_eq")).alias("last"),
                     piece.alias("first")).repartition("first")
    rows = rows.select("sample", F.explode(F.sequence("first", F.least(F.col("last"), F.col("first") + (QQ_PIECE - 1)))).alias("i"))
    last = 0.5 ** (1.0 / max(1, n))
    m = (F.when(F.col("i") == 1, F.lit(1.0 - last)).when(F.col("i") == n, F.lit(last))
         .otherwise((F.col("i") - 0.3175) / F.lit(n + 0.365)))
    return rows.withColumn("m", m).select("i", F.expr(inverse_normal_sql("m")).alias("theoretical"), "sample")


def unique_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_distinct(c).alias(c) for c in cols]).first()
    rows = [(c, int(row[c]), int(row[c]) == int(row["__n"])) for c in cols]
    return _rows_df(df.sparkSession, rows, "column string, n_distinct long, is_unique boolean")


def profile_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: n, missing, distinct, zeros, mean, std, cv, skewness and
    excess kurtosis (population moments), min/max, 5/25/50/75/95 % and MAD."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"cnt_{c}"),
                 F.count(F.when(x == 0, 1)).alias(f"z_{c}"), F.avg(x).alias(f"m_{c}"),
                 F.stddev_samp(x).alias(f"s_{c}"), F.skewness(x).alias(f"sk_{c}"), F.kurtosis(x).alias(f"ku_{c}"),
                 F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}")]
    row = df.agg(*aggs).first()
    n = int(row["__n"])
    qs = exact_quantiles_many(df, cols, [0.05, 0.25, 0.5, 0.75, 0.95])
    dev = df.select(*[F.abs(F.col(c).cast("double") - F.lit(qs[c][2]).cast("double")).alias(c) for c in cols])
    mads = exact_quantiles_many(dev, cols, [0.5])
    names = [f"c{i}" for i in range(len(cols))]
    values = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)]).unpivot([], names, "__col", "__val")
    distinct = dict(values.filter("__val is not null").distinct().groupBy("__col").count().collect())  # a row per column
    rows = []
    for k, c in enumerate(cols):
        mad = mads[c][0]
        mean, sd = row[f"m_{c}"], row[f"s_{c}"]
        rows.append((c, n, n - int(row[f"cnt_{c}"]), int(distinct.get(names[k], 0)), int(row[f"z_{c}"]), mean, sd,
                     (sd / mean) if (sd is not None and mean) else None, row[f"sk_{c}"], row[f"ku_{c}"],
                     row[f"lo_{c}"], row[f"hi_{c}"], *qs[c], mad))
    return _rows_df(df.sparkSession, rows,
                    "column string, n long, missing long, distinct long, zeros long, mean double, std double, "
                    "cv double, skewness double, kurtosis double, min double, max double, q05 double, q25 double, "
                    "q50 double, q75 double, q95 double, mad double")


def profile_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    n = df.count()
    d = describe_categorical(df, cols)
    return d.select("column", F.lit(n).cast("long").alias("n"), (F.lit(n) - F.col("count")).alias("missing"),
                    F.col("unique").alias("distinct"), "top", "freq")


# Alert thresholds (our choice; the reference used a profiling library's defaults).
ALERTS = {"missing_pct": 5.0, "high_cardinality": 0.5, "skewed": 1.0, "zeros_pct": 10.0, "high_corr": 0.9}


def profile_alerts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   thresholds: dict[str, float] | None = None) -> DataFrame:
    t = dict(ALERTS, **(thresholds or {}))
    pn = profile_numeric(df, numeric)
    pc = profile_categorical(df, categorical)
    num = pn.select("column", F.explode(F.array(
        F.when(F.col("distinct") <= 1, "constant"),
        F.when(F.try_divide(F.col("missing") * 100.0, F.col("n")) > t["missing_pct"], "missing"),
        F.when(F.abs("skewness") > t["skewed"], "skewed"),
        F.when(F.try_divide(F.col("zeros") * 100.0, F.col("n")) > t["zeros_pct"], "zeros"))).alias("alert"))
    cat = pc.select("column", F.explode(F.array(
        F.when(F.col("distinct") <= 1, "constant"),
        F.when(F.try_divide(F.col("missing") * 100.0, F.col("n")) > t["missing_pct"], "missing"),
        F.when(F.try_divide(F.col("distinct"), F.col("n") - F.col("missing")) > t["high_cardinality"],
               "high_cardinality"))).alias("alert"))
    cm = corr_matrix(df, numeric).filter((F.col("var_a") != F.col("var_b")) & (F.abs("corr") > t["high_corr"]))
    corr = cm.select(F.col("var_a").alias("column")).distinct().withColumn("alert", F.lit("high_correlation"))
    return num.unionByName(cat).unionByName(corr).filter(F.col("alert").isNotNull())


def prep_sanity(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    return _rows_df(df.sparkSession, [(c, row[f"m_{c}"], row[f"s_{c}"]) for c in cols],
                    "column string, mean double, sd double")
