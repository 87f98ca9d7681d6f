"""Listing-shaped views derived from the driver's TPC-H-like tables.

The expressions are plain SQL that both Spark and DuckDB evaluate identically,
so the same text builds the Spark view and the oracle CTE (see FIXTURES.md).
Work grows with the input: one row per ``part`` row, prices from a grouped
``lineitem`` aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed fixture definition (FIXTURES.md §3): k = p_partkey, z = p_size,
# lo / hi = min / max(l_extendedprice) per part.
LISTING_COLUMNS: list[tuple[str, str]] = [
    ("id", "p_partkey"),
    ("name", "concat(p_name, ' #', cast(p_partkey as varchar(20)))"),
    ("brand", "p_brand"),
    ("base_name", "p_name"),
    ("screen_size", "10.0E0 + p_size/10.0E0"),
    ("screen_surface", "CASE p_partkey%7 WHEN 0 THEN 'Matte' WHEN 1 THEN 'matte' WHEN 2 THEN 'Glossy' "
                       "WHEN 3 THEN 'glossy' WHEN 4 THEN ' ' WHEN 5 THEN NULL ELSE 'Matte' END"),
    ("pixels_x", "CASE p_size%8 WHEN 0 THEN 1024 WHEN 1 THEN 1366 WHEN 2 THEN 1600 WHEN 3 THEN 1920 "
                 "WHEN 4 THEN 2304 WHEN 5 THEN 2560 WHEN 6 THEN 3840 ELSE 1920 END"),
    ("pixels_y", "CASE p_size%8 WHEN 0 THEN 768 WHEN 1 THEN 768 WHEN 2 THEN 900 WHEN 3 THEN 1080 "
                 "WHEN 4 THEN 1440 WHEN 5 THEN 1440 WHEN 6 THEN 2160 ELSE 1200 END"),
    ("touchscreen", "CASE WHEN p_partkey%4=0 THEN 1 ELSE 0 END"),
    ("detachable_keyboard", "CASE WHEN p_partkey%13=0 THEN NULL WHEN p_partkey%5=0 THEN 1 ELSE 0 END"),
    ("discrete_gpu", "CASE WHEN p_partkey%3=0 THEN 1 ELSE 0 END"),
    ("cpu", "p_type"),
    ("cpu_details", "CASE WHEN p_partkey%11=0 THEN NULL WHEN p_partkey%2=0 THEN concat(p_type,' ',"
                    "cast(1+p_partkey%4 as varchar(9)),'.',cast(p_partkey%10 as varchar(9)),' GHz') "
                    "ELSE concat(p_type,' ',cast(1+p_partkey%4 as varchar(9)),'.',"
                    "cast(10+p_partkey%90 as varchar(9)),'ghz') END"),
    ("gpu", "CASE WHEN p_partkey%19=0 THEN NULL ELSE concat('GPU ', p_brand) END"),
    ("os", "CASE WHEN p_partkey%17=0 THEN NULL WHEN p_partkey%6=0 THEN 'macOS' "
           "WHEN p_partkey%6=1 THEN 'Chrome OS' ELSE 'Windows' END"),
    ("os_details", "CASE WHEN p_partkey%17=0 THEN NULL WHEN p_partkey%6=0 THEN 'macOS Catalina' "
                   "ELSE 'Windows 10' END"),
    ("ram", "CASE p_partkey%4 WHEN 0 THEN 4 WHEN 1 THEN 8 WHEN 2 THEN 16 ELSE 32 END"),
    ("ssd", "CASE p_size%6 WHEN 0 THEN 0 WHEN 1 THEN 32 WHEN 2 THEN 128 WHEN 3 THEN 256 "
            "WHEN 4 THEN 512 ELSE 1024 END"),
    ("storage", "CASE p_size%5 WHEN 0 THEN 0 WHEN 1 THEN 256 WHEN 2 THEN 1000 WHEN 3 THEN 2000 ELSE 4000 END"),
    ("weight", "CASE WHEN p_partkey%10=3 THEN NULL ELSE 1.0E0 + (p_partkey%23)/10.0E0 END"),
    ("min_price", "cast(floor(p_retailprice*0.2E0 + p_size*20.0E0 + (p_partkey%4)*150.0E0 + lo*0.03E0) as double)"),
    ("max_price", "cast(floor(p_retailprice*0.2E0 + p_size*20.0E0 + (p_partkey%4)*150.0E0 + lo*0.03E0 "
                  "+ hi*0.0039E0) as double)"),
]

PREDS_COLUMNS: list[tuple[str, str]] = [
    ("id", "p_partkey"),
    ("pmn", "p_retailprice*0.9E0 + (p_partkey%50)*3.0E0"),
    ("pmx", "p_retailprice*0.95E0 + (p_partkey%37)*3.0E0"),
]

_LISTING_FROM = ("part JOIN (SELECT l_partkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi "
                 "FROM lineitem GROUP BY l_partkey) li ON part.p_partkey = li.l_partkey")


def _select_list(cols: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in cols)


def listing_sql() -> str:
    """``SELECT`` text of the listing view over tables ``part`` and ``lineitem``."""
    return f"SELECT\n  {_select_list(LISTING_COLUMNS)}\nFROM {_LISTING_FROM}"


def preds_sql() -> str:
    return f"SELECT {_select_list(PREDS_COLUMNS)} FROM part"


def cv_results_sql() -> str:
    return ("SELECT l_linenumber AS config_id, cast(l_suppkey % 5 AS INTEGER) AS fold, "
            "round(avg(l_extendedprice), 4) AS value FROM lineitem GROUP BY l_linenumber, l_suppkey % 5")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part.  The lineitem side is aggregated map-side first, so the
    shuffle carries one partial (min, max) per part per task, then joined on the
    part key (sort-merge at scale; AQE turns it into a broadcast when small)."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    prices = (table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice")
              .groupBy("l_partkey")
              .agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")))
    joined = part.join(prices, part.p_partkey == prices.l_partkey, "inner")
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in LISTING_COLUMNS])


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {n}" for n, e in PREDS_COLUMNS])


def cv_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_linenumber").alias("config_id"),
                       (F.col("l_suppkey") % 5).cast("int").alias("fold"))
            .agg(F.round(F.avg("l_extendedprice"), 4).alias("value")))


def oracle_with(body: str, extra_ctes: dict[str, str] | None = None) -> str:
    """Wrap an oracle query with the fixture CTEs it references."""
    import re

    ctes: dict[str, str] = {}
    text = body + " ".join((extra_ctes or {}).values())
    if re.search(r"\blisting\b", text):
        ctes["listing"] = listing_sql()
    if re.search(r"\bpreds\b", text):
        ctes["preds"] = preds_sql()
    if re.search(r"\bcv_results\b", text):
        ctes["cv_results"] = cv_results_sql()
    ctes.update(extra_ctes or {})
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes.items()) + "\n" + body
