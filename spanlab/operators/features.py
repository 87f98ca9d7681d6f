"""Feature derivation operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def with_resolution(df: DataFrame, x: str = "pixels_x", y: str = "pixels_y") -> DataFrame:
    return df.withColumn("resolution_string", C.resolution_string(x, y))


def hd_category(df: DataFrame, x: str = "pixels_x", y: str = "pixels_y", drop: Sequence[str] = (),
                keep_resolution: bool = False, labels: dict[str, str] | None = None) -> DataFrame:
    """HD class from pixel counts; ``labels`` renames classes (e.g. the R capitalisation)."""
    expr = C.hd_category(x, y)
    if labels:
        expr = F.coalesce(F.create_map(*[F.lit(v) for kv in labels.items() for v in kv])[expr], expr)
    out = df.withColumn("hd_resolution_category", expr)
    if keep_resolution:
        out = out.withColumn("resolution_string", C.resolution_string(x, y))
    return out.drop(*drop)


def size_category(df: DataFrame, col: str, bands, default: str, out: str | None = None,
                  drop: bool = True) -> DataFrame:
    res = df.withColumn(out or f"{col}_category", C.banded(col, bands, default))
    return res.drop(col) if drop else res


def ssd_category(df: DataFrame, col: str = "ssd", drop: bool = True) -> DataFrame:
    return size_category(df, col, C.SSD_BANDS, C.SSD_DEFAULT, drop=drop)


def storage_category(df: DataFrame, col: str = "storage", drop: bool = True) -> DataFrame:
    return size_category(df, col, C.STORAGE_BANDS, C.STORAGE_DEFAULT, drop=drop)


def cpu_frequency(df: DataFrame, col: str = "cpu_details", strict: bool = True, drop: bool = True) -> DataFrame:
    res = df.withColumn("cpu_frequency", C.cpu_frequency(col, strict=strict))
    return res.drop(col) if drop else res


def cpu_frequency_spaced(df: DataFrame, col: str = "cpu_details") -> DataFrame:
    return df.withColumn("cpu_frequency", C.cpu_frequency_spaced(col))


def price_spread(df: DataFrame, lo: str = "min_price", hi: str = "max_price",
                 out: str = "max_min_difference") -> DataFrame:
    return df.withColumn(out, F.col(hi) - F.col(lo))


def price_tag(df: DataFrame, col: str = "min_price") -> DataFrame:
    return df.withColumn("price_tag", C.price_tag(col))


def binary_surface(df: DataFrame, col: str = "screen_surface", positive: str = "glossy") -> DataFrame:
    return df.withColumn(col, F.coalesce((F.col(col) == positive).cast("int"), F.lit(0)))


class LumpRareModel:
    """Fitted rare-level table (one row per rare level), joined on the level; the
    planner picks the join from the table's size."""

    def __init__(self, col: str, rare: DataFrame, other: str):
        self.col, self.rare, self.other = col, rare, other

    def transform(self, df: DataFrame) -> DataFrame:
        flag = "__lump_flag"
        table = self.rare.withColumn(flag, F.lit(True))
        joined = df.join(table, on=self.col, how="left")
        out = joined.withColumn(self.col, F.when(F.col(flag), F.lit(self.other)).otherwise(F.col(self.col)))
        return out.select(*df.columns)


def fit_lump_rare(train: DataFrame, col: str, min_count: int = 9, keep: Sequence[str] = (),
                  force: Sequence[str] = (), other: str = "Other1") -> LumpRareModel:
    """Levels with count < ``min_count`` (minus ``keep``, plus ``force``) become ``other``.

    The level table is a grouped count (partial aggregation before the shuffle)
    with one row per distinct level.
    """
    counts = train.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter(F.col(col).isNotNull())
    cond = (F.col("n") < min_count)
    if keep:
        cond = cond & ~F.col(col).isin(*keep)
    if force:
        cond = cond | F.col(col).isin(*force)
    return LumpRareModel(col, counts.filter(cond).select(col), other)


def log_target(df: DataFrame, cols: Sequence[str], inverse: bool = False) -> DataFrame:
    fn = F.exp if inverse else F.log
    return df.select(*[fn(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def invert_target(df: DataFrame, col: str, mean: float = 0.0, sd: float = 1.0, fn=None,
                  out: str | None = None) -> DataFrame:
    """``fn(col * sd + mean)``; ``fn`` is a Column → Column function (identity by default)."""
    base = F.col(col) * F.lit(float(sd)) + F.lit(float(mean))
    return df.withColumn(out or col, fn(base) if fn else base)


# ---------------------------------------------------------------------------
# Documented-only features (prose in the reference's data description).  The
# rule tables are parameters; these defaults are our own illustrative choices.
# ---------------------------------------------------------------------------
DEFAULT_KEYWORD_RULES = (("gaming", "(?i)gaming|rog|legion|omen|predator"),
                         ("ultrabook", "(?i)ultrabook|zenbook|xps|spectre|air"),
                         ("notebook", "(?i)notebook|book|ideapad|inspiron|aspire"))


def portability_group(df: DataFrame, weight: str = "weight", size: str = "screen_size",
                      light: tuple[float, float] = (1.5, 14.0), heavy: tuple[float, float] = (2.5, 16.0)) -> DataFrame:
    w, s = F.col(weight), F.col(size)
    expr = (F.when((w <= light[0]) & (s <= light[1]), "light")
            .when((w >= heavy[0]) | (s >= heavy[1]), "heavy")
            .when(w.isNull() | s.isNull(), F.lit(None).cast("string"))
            .otherwise("medium"))
    return df.withColumn("portability", expr)


def keyword_class(df: DataFrame, col: str = "name", rules=DEFAULT_KEYWORD_RULES, default: str = "other",
                  out: str = "keyword_class") -> DataFrame:
    expr = None
    for label, pattern in rules:
        cond = F.col(col).rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return df.withColumn(out, expr.otherwise(default) if expr is not None else F.lit(default))


def brand_tier(df: DataFrame, col: str = "brand", top: Sequence[str] = (), out: str = "brand_tier") -> DataFrame:
    return df.withColumn(out, F.when(F.lower(F.col(col)).isin(*[t.lower() for t in top]), "top").otherwise("other"))


def regex_feature(df: DataFrame, col: str, pattern: str, out: str, group: int = 1,
                  cast: str | None = None) -> DataFrame:
    """Generic extractor (CPU generation, core count, GPU memory ...): first match of
    ``group``; no match → NULL."""
    v = F.nullif(F.regexp_extract(F.col(col), pattern, group), F.lit(""))
    return df.withColumn(out, v.try_cast(cast) if cast else v)
