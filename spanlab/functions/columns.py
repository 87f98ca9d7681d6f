"""Column-expression builders (JVM side, whole-stage codegen friendly).

Every function here returns a ``pyspark.sql.Column``; none of them call Python
per row.  Constants that have to equal the reference's are gathered at the top.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Resolutions treated as "retina", checked before the pixel-width rules.
RETINA_RESOLUTIONS = ("2304x1440", "2560x1600", "2880x1800")
# HD width rules, in evaluation order: hd [1200, 1600], fullhd == 1920,
# qhd/uhd (1920, 3840), 4k == 3840, everything else (and NULL) sd.
HD_LABELS = ("retina", "hd", "fullhd", "qhd/uhd", "4k", "sd")
# SSD bands: 0 none, < 64 small, <= 256 medium, else large.
SSD_BANDS = (("==", 0, "none"), ("<", 64, "small"), ("<=", 256, "medium"))
SSD_DEFAULT = "large"
# Storage bands: 0 none, <= 256 small, <= 1028 medium, <= 2056 large, else very large.
STORAGE_BANDS = (("==", 0, "none"), ("<=", 256, "small"), ("<=", 1028, "medium"), ("<=", 2056, "large"))
STORAGE_DEFAULT = "very large"
# Price tag on the min price: <= 500 low, <= 1300 medium, else high.
PRICE_TAG_BANDS = (("<=", 500, "low"), ("<=", 1300, "medium"))
PRICE_TAG_DEFAULT = "high"
# CPU frequency patterns as written (unescaped dot, both summed).
FREQ_PATTERNS_COMPAT = (r"\s*([0-9].[0-9][0-9])\s*[gG][hH][zZ]", r"\s*([0-9].[0-9])\s*[gG][hH][zZ]")
# Strict variant: literal dot, first pattern wins.
FREQ_PATTERNS_STRICT = (r"([0-9]\.[0-9][0-9])\s*[gG][hH][zZ]", r"([0-9]\.[0-9])\s*[gG][hH][zZ]")
# R variant: needs surrounding whitespace, " GHz" stripped before the cast.
FREQ_PATTERN_SPACED = r"\s+[0-9].[0-9][0-9]\s+[gG][hH][zZ]|\s+[0-9].[0-9]\s+[gG][hH][zZ]"
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column) -> Column:
    """Round a double to 6 decimals (oracle hygiene)."""
    return F.round(col(c), 6)


def banded(c: str | Column, bands: Sequence[tuple[str, float, str]], default: str) -> Column:
    """Chained CASE over (op, threshold, label); NULL falls through to ``default``
    exactly like a NaN comparison in the reference's row functions."""
    c = col(c)
    ops = {"==": c.__eq__, "<": c.__lt__, "<=": c.__le__, ">": c.__gt__, ">=": c.__ge__}
    out = None
    for op, thr, label in bands:
        cond = ops[op](F.lit(thr))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default) if out is not None else F.lit(default)


def resolution_string(x: str | Column = "pixels_x", y: str | Column = "pixels_y") -> Column:
    return F.concat(col(x).cast("string"), F.lit("x"), col(y).cast("string"))


def hd_category(x: str | Column = "pixels_x", y: str | Column = "pixels_y") -> Column:
    x = col(x)
    res = resolution_string(x, y)
    return (F.when(res.isin(*RETINA_RESOLUTIONS), HD_LABELS[0])
            .when((x >= 1200) & (x <= 1600), HD_LABELS[1])
            .when(x == 1920, HD_LABELS[2])
            .when((x > 1920) & (x < 3840), HD_LABELS[3])
            .when(x == 3840, HD_LABELS[4])
            .otherwise(HD_LABELS[5]))


def ssd_category(c: str | Column = "ssd") -> Column:
    return banded(c, SSD_BANDS, SSD_DEFAULT)


def storage_category(c: str | Column = "storage") -> Column:
    return banded(c, STORAGE_BANDS, STORAGE_DEFAULT)


def price_tag(c: str | Column = "min_price") -> Column:
    return banded(c, PRICE_TAG_BANDS, PRICE_TAG_DEFAULT)


def _freq_part(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("double")


def cpu_frequency(c: str | Column = "cpu_details", strict: bool = True) -> Column:
    """GHz value from a free-text CPU description.

    ``strict=False`` reproduces the reference: both patterns, missing → 0,
    summed, 0 → NULL.  ``strict=True`` escapes the dot and takes the first match.
    """
    c = col(c)
    if strict:
        a, b = FREQ_PATTERNS_STRICT
        return F.coalesce(_freq_part(c, a), _freq_part(c, b))
    a, b = FREQ_PATTERNS_COMPAT
    total = F.coalesce(_freq_part(c, a), F.lit(0.0)) + F.coalesce(_freq_part(c, b), F.lit(0.0))
    return F.when(total > 0, total)


def cpu_frequency_spaced(c: str | Column = "cpu_details") -> Column:
    m = F.regexp_extract(col(c), FREQ_PATTERN_SPACED, 0)
    return F.trim(F.regexp_replace(m, " GHz", "")).try_cast("double")


def yeo_johnson(x: str | Column, lam: float) -> Column:
    """Yeo-Johnson power transform at a fixed lambda."""
    x = col(x)
    if abs(lam) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, lam) - 1.0) / lam
    if abs(lam - 2.0) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_inverse(y: str | Column, lam: float) -> Column:
    y = col(y)
    if abs(lam) < 1e-12:
        pos = F.expm1(y)
    else:
        pos = F.pow(y * lam + 1.0, 1.0 / lam) - 1.0
    if abs(lam - 2.0) < 1e-12:
        neg = -F.expm1(-y)
    else:
        neg = 1.0 - F.pow(1.0 - (2.0 - lam) * y, 1.0 / (2.0 - lam))
    return F.when(y >= 0, pos).otherwise(neg)


def box_cox(x: str | Column, lam: float) -> Column:
    x = col(x)
    if abs(lam) < 1e-12:
        return F.when(x > 0, F.log(x))
    return F.when(x > 0, (F.pow(x, lam) - 1.0) / lam)


def box_cox_inverse(y: str | Column, lam: float) -> Column:
    y = col(y)
    if abs(lam) < 1e-12:
        return F.exp(y)
    return F.pow(y * lam + 1.0, 1.0 / lam)


# Rational approximation of the standard normal quantile (Acklam, 2003), written
# as SQL text so that Spark and the DuckDB oracle evaluate the same formula.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00)


def _horner(coefs: Sequence[float], v: str) -> str:
    s = repr(coefs[0])
    for c in coefs[1:]:
        s = f"(({s})*{v} + ({c!r}))"
    return s


def inverse_normal_sql(p: str) -> str:
    """SQL expression for Φ⁻¹(p), 0 < p < 1 (relative error < 1.2e-9)."""
    lo = 0.02425
    q_tail_lo = f"sqrt(-2.0E0*ln({p}))"
    q_tail_hi = f"sqrt(-2.0E0*ln(1.0E0-({p})))"
    tail_lo = f"({_horner(_C, q_tail_lo)}) / ({_horner(_D + (1.0,), q_tail_lo)})"
    tail_hi = f"-({_horner(_C, q_tail_hi)}) / ({_horner(_D + (1.0,), q_tail_hi)})"
    q = f"(({p}) - 0.5E0)"
    r = f"({q}*{q})"
    central = f"({_horner(_A, r)})*{q} / ({_horner(_B + (1.0,), r)})"
    return (f"(CASE WHEN ({p}) < {lo!r} THEN {tail_lo} "
            f"WHEN ({p}) > {1 - lo!r} THEN {tail_hi} ELSE {central} END)")


def inverse_normal(p: str | Column) -> Column:
    name = p if isinstance(p, str) else None
    if name is None:
        raise TypeError("pass a column name (the expression is SQL text)")
    return F.expr(inverse_normal_sql(f"`{name}`"))


def normal_quantile_scalar(p: float) -> float:
    """Driver-side scalar version (used only for constants)."""
    return math.sqrt(2.0) * _erfinv(2.0 * p - 1.0)


def _erfinv(y: float) -> float:
    # Newton refinement on math.erf; only used for a handful of scalars.
    x = 0.0
    for _ in range(100):
        err = math.erf(x) - y
        x -= err / (2.0 / math.sqrt(math.pi) * math.exp(-x * x))
        if abs(err) < 1e-15:
            break
    return x


def hash_key(key: str | Column, seed: int | str | Column) -> Column:
    """Deterministic per-row hash, md5(seed:key) as hex — identical in DuckDB."""
    s = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(s, F.lit(":"), col(key).cast("string")))


def hash_unit(key: str | Column, seed: int | str) -> Column:
    """Uniform [0, 1) value from the first 13 hex digits of md5(seed:key)."""
    h = F.substring(hash_key(key, seed), 1, 13)
    return F.conv(h, 16, 10).cast("double") / float(16 ** 13)
