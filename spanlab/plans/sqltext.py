"""SQL text of the column rules, for the DuckDB oracle (and ``spark.sql`` users).

Each function mirrors a Column builder in ``functions.columns`` and uses the
same fixed values, so the two engines evaluate the same rule.
"""

from __future__ import annotations

from ..functions import columns as C


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hd_sql(x: str = "pixels_x", y: str = "pixels_y") -> str:
    res = f"concat(cast({x} AS VARCHAR), 'x', cast({y} AS VARCHAR))"
    lab = C.HD_LABELS
    return (f"CASE WHEN {res} IN ({', '.join(q(r) for r in C.RETINA_RESOLUTIONS)}) THEN {q(lab[0])} "
            f"WHEN {x} >= 1200 AND {x} <= 1600 THEN {q(lab[1])} WHEN {x} = 1920 THEN {q(lab[2])} "
            f"WHEN {x} > 1920 AND {x} < 3840 THEN {q(lab[3])} WHEN {x} = 3840 THEN {q(lab[4])} ELSE {q(lab[5])} END")


def band_sql(col: str, bands, default: str) -> str:
    ops = {"==": "="}
    parts = " ".join(f"WHEN {col} {ops.get(op, op)} {thr} THEN {q(label)}" for op, thr, label in bands)
    return f"CASE {parts} ELSE {q(default)} END"


def ssd_sql(col: str = "ssd") -> str:
    return band_sql(col, C.SSD_BANDS, C.SSD_DEFAULT)


def storage_sql(col: str = "storage") -> str:
    return band_sql(col, C.STORAGE_BANDS, C.STORAGE_DEFAULT)


def price_tag_sql(col: str = "min_price") -> str:
    return band_sql(col, C.PRICE_TAG_BANDS, C.PRICE_TAG_DEFAULT)


def _part(col: str, pat: str) -> str:
    return f"cast(nullif(regexp_extract({col}, {q(pat)}, 1), '') AS DOUBLE)"


def freq_sql(col: str = "cpu_details", strict: bool = True) -> str:
    if strict:
        a, b = C.FREQ_PATTERNS_STRICT
        return f"coalesce({_part(col, a)}, {_part(col, b)})"
    a, b = C.FREQ_PATTERNS_COMPAT
    tot = f"(coalesce({_part(col, a)}, 0.0E0) + coalesce({_part(col, b)}, 0.0E0))"
    return f"CASE WHEN {tot} > 0 THEN {tot} END"


def freq_spaced_sql(col: str = "cpu_details") -> str:
    m = f"regexp_extract({col}, {q(C.FREQ_PATTERN_SPACED)}, 0)"
    return f"TRY_CAST(trim(replace({m}, ' GHz', '')) AS DOUBLE)"


def hash_sql(key: str, seed) -> str:
    return f"md5(concat('{seed}', ':', cast({key} AS VARCHAR)))"


def yj_sql(x: str, lam: float | str) -> str:
    lam_s = str(lam)
    pos0 = f"ln(1 + {x})"
    neg2 = f"-ln(1 - {x})"
    pos = f"(CASE WHEN abs({lam_s}) < 1e-12 THEN {pos0} ELSE (pow({x} + 1.0E0, {lam_s}) - 1.0E0) / ({lam_s}) END)"
    neg = (f"(CASE WHEN abs({lam_s} - 2.0E0) < 1e-12 THEN {neg2} "
           f"ELSE -(pow(1.0E0 - {x}, 2.0E0 - {lam_s}) - 1.0E0) / (2.0E0 - {lam_s}) END)")
    return f"(CASE WHEN {x} >= 0 THEN {pos} ELSE {neg} END)"


def bc_sql(x: str, lam: float | str) -> str:
    lam_s = str(lam)
    return (f"(CASE WHEN {x} > 0 THEN (CASE WHEN abs({lam_s}) < 1e-12 THEN ln({x}) "
            f"ELSE (pow({x}, {lam_s}) - 1.0E0) / ({lam_s}) END) END)")
