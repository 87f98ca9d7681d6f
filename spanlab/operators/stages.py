"""Extension surface: the feature operators as saveable
``pyspark.ml`` stages, a function-as-stage wrapper, a metric set, and column
selectors by role.  Every stage's ``_transform`` is a Column expression — no
Python row function."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from . import clean, features


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop the source column(s)",
                         typeConverter=TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(dropOriginal=False)


class LowerCaseStrings(_Stage):
    """Lower-case every string column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return clean.lower_strings(df)


class SurfaceFixer(_Stage, HasInputCol):
    """Blank → NULL, then the case recode of the surface column (C4)."""

    def __init__(self, inputCol: str = "screen_surface"):
        super().__init__()
        self._set(inputCol=inputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return clean.fix_surface(df, self.getInputCol())


class HdCategorizer(_Stage):
    """HD class from the two pixel columns (F2)."""

    def __init__(self, dropOriginal: bool = False):
        super().__init__()
        self._set(dropOriginal=dropOriginal)

    def _transform(self, df: DataFrame) -> DataFrame:
        drop = ("pixels_x", "pixels_y") if self.getOrDefault(self.dropOriginal) else ()
        return features.hd_category(df, drop=drop)


class SizeCategorizer(_Stage, HasInputCol):
    """SSD (F3) or storage (F4) bands, chosen by the input column."""

    def __init__(self, inputCol: str = "ssd", dropOriginal: bool = True):
        super().__init__()
        self._set(inputCol=inputCol, dropOriginal=dropOriginal)

    def _transform(self, df: DataFrame) -> DataFrame:
        c, drop = self.getInputCol(), self.getOrDefault(self.dropOriginal)
        if c == "storage":
            return features.storage_category(df, c, drop=drop)
        return features.ssd_category(df, c, drop=drop)


class CpuFrequencyExtractor(_Stage, HasInputCol):
    """GHz figure from the CPU description."""

    strict = Param(Params._dummy(), "strict", "escaped dot and no double count", typeConverter=TypeConverters.toBoolean)

    def __init__(self, inputCol: str = "cpu_details", strict: bool = True, dropOriginal: bool = True):
        super().__init__()
        self._set(inputCol=inputCol, strict=strict, dropOriginal=dropOriginal)

    def _transform(self, df: DataFrame) -> DataFrame:
        return features.cpu_frequency(df, self.getInputCol(), strict=self.getOrDefault(self.strict),
                                      drop=self.getOrDefault(self.dropOriginal))


class FnTransformer(Transformer):
    """A ``DataFrame → DataFrame`` function as a pipeline stage (U3); not
    persistable (the function is code, not parameters)."""

    def __init__(self, fn: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.fn = fn

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fn(df)


# ---------------------------------------------------------------------------
# Metric set (U5): named aggregate builders, all computed in one pass
# ---------------------------------------------------------------------------
def _sse(t, p):
    return F.sum(F.pow(F.col(t) - F.col(p), 2))


METRICS: dict[str, Callable[[str, str], Column]] = {
    "mae": lambda t, p: F.avg(F.abs(F.col(t) - F.col(p))),
    "rmse": lambda t, p: F.sqrt(F.avg(F.pow(F.col(t) - F.col(p), 2))),
    "rsq_trad": lambda t, p: F.lit(1.0) - F.try_divide(_sse(t, p), F.count(F.col(t)) * F.var_pop(F.col(t))),
    "rsq": lambda t, p: F.pow(F.try_divide(F.covar_pop(F.col(t), F.col(p)), F.stddev_pop(F.when(F.col(p).isNotNull(), F.col(t))) * F.stddev_pop(F.when(F.col(t).isNotNull(), F.col(p)))), 2),
}


def metric_set(df: DataFrame, truth: str, pred: str, names: Sequence[str] = ("mae", "rmse", "rsq_trad")) -> DataFrame:
    return df.agg(*[METRICS[n](truth, pred).alias(n) for n in names])


# ---------------------------------------------------------------------------
# Selectors by role
# ---------------------------------------------------------------------------
def all_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def all_nominal(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in exclude]


def all_outcomes(roles: dict[str, str]) -> list[str]:
    return [c for c, r in roles.items() if r == "outcome"]


def all_predictors(df: DataFrame, roles: dict[str, str]) -> list[str]:
    """Columns whose role is ``predictor`` (the default for unlisted columns)."""
    return [c for c in df.columns if roles.get(c, "predictor") == "predictor"]
