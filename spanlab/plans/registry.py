"""Collects the query catalogue modules into the two driver dictionaries."""

from __future__ import annotations

import importlib

from pyspark.sql import SparkSession

_MODULES = ["spanlab.plans.catalog", "spanlab.plans.catalog_more", "spanlab.plans.catalog_ml",
            "spanlab.plans.catalog_text", "spanlab.plans.catalog_recipe"]


def _load():
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise
    from . import catalog
    return catalog


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str):
        from ..session import ensure_checkpoint_dir, ship_package
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries():
    cat = _load()
    return {k: _wrap(v) for k, v in cat.QUERIES.items()}


def oracle_sql():
    return dict(_load().ORACLE)
