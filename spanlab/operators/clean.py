"""Projection, filtering and cleaning operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

BLANK_PATTERN = r"^\s*$"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def drop_cols_regex(df: DataFrame, pattern: str = "Unnamed") -> DataFrame:
    """Drop columns whose *name* matches ``pattern`` (metadata only, no job)."""
    rx = re.compile(pattern)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not rx.search(c)])


def snake_case(name: str) -> str:
    s = name.replace("﻿", "").strip()
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(df: DataFrame) -> DataFrame:
    """Header to snake_case, de-duplicated with the first numeric suffix that makes a name not used before."""
    out: list[str] = []
    used: set[str] = set()
    for c in df.columns:
        base, n = snake_case(c), 1
        s = base
        while s in used:
            n += 1
            s = f"{base}_{n}"
        used.add(s)
        out.append(s)
    return df.toDF(*out)


def lower_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Lower-case every string column (or ``cols``); keeps column order."""
    targets = set(cols if cols is not None else string_columns(df))
    return df.select(*[F.lower(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def recode(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values of one column by a small mapping."""
    expr = F.col(col)
    out = None
    for k, v in mapping.items():
        out = (F.when(expr == k, v) if out is None else out.when(expr == k, v))
    if out is None:
        return df
    return df.withColumn(col, out.otherwise(expr))


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    targets = set(cols if cols is not None else string_columns(df))
    return df.select(*[
        F.when(F.col(c).rlike(BLANK_PATTERN), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c) for c in df.columns])


# The surface fixer maps lower-case spellings back to the capitalised ones.
SURFACE_FIX = {"matte": "Matte", "glossy": "Glossy"}
SURFACE_LOWER = {"Glossy": "glossy", "Matte": "matte"}


def fix_surface(df: DataFrame, col: str = "screen_surface") -> DataFrame:
    """Blank strings → NULL on all string columns, then recode the surface levels."""
    return recode(blank_to_null(df), col, SURFACE_FIX)


def drop_columns(df: DataFrame, names: Iterable[str] = (), pattern: str | None = None) -> DataFrame:
    names = set(names)
    keep = [c for c in df.columns if c not in names and not (pattern and pattern in c)]
    return df.select(*keep)


def dropna_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def drop_wide_spread(df: DataFrame, lo: str = "min_price", hi: str = "max_price",
                     threshold: float = 400.0) -> DataFrame:
    """Drop rows whose spread exceeds ``threshold``; NULL spreads are kept."""
    diff = F.col(hi) - F.col(lo)
    return df.filter(~(diff > threshold) | diff.isNull())


def truncate_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    targets = set(cols)
    return df.select(*[F.col(c).cast("int").alias(c) if c in targets else F.col(c) for c in df.columns])


def numeric_as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    targets = set(cols)
    return df.select(*[F.col(c).cast("string").alias(c) if c in targets else F.col(c) for c in df.columns])


def distinct_levels(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def select_non_numeric(df: DataFrame) -> DataFrame:
    return df.select(*non_numeric_columns(df))
