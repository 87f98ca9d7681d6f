"""Sources and sinks: delimited listing tables, prediction
files, split tables, experiment results.  All reads carry an explicit schema;
all writes are distributed Spark writes (no driver-side file handling)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..operators.clean import clean_names, drop_cols_regex

LISTING_SCHEMA = StructType([
    StructField("id", LongType()), StructField("name", StringType()), StructField("brand", StringType()),
    StructField("base_name", StringType()), StructField("screen_size", DoubleType()),
    StructField("screen_surface", StringType()), StructField("pixels_x", IntegerType()),
    StructField("pixels_y", IntegerType()), StructField("touchscreen", IntegerType()),
    StructField("detachable_keyboard", IntegerType()), StructField("discrete_gpu", IntegerType()),
    StructField("cpu", StringType()), StructField("cpu_details", StringType()), StructField("gpu", StringType()),
    StructField("os", StringType()), StructField("os_details", StringType()), StructField("ram", IntegerType()),
    StructField("ssd", IntegerType()), StructField("storage", IntegerType()), StructField("weight", DoubleType()),
    StructField("min_price", DoubleType()), StructField("max_price", DoubleType()),
])
# Blanks in and around values are part of them; quotes inside values are doubled.
_CSV = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quote": '"', "escape": '"'}
_EMPTY = "\x00empty\x00"
BOM = "﻿"


def read_listing(spark: SparkSession, path: str, sep: str = ",", schema: StructType | None = LISTING_SCHEMA,
                 drop_regex: str | None = "Unnamed", normalise_names: bool = False) -> DataFrame:
    """Delimited listing table with header (S1/S2).  Names come from the header
    with the UTF-8 BOM stripped, junk columns dropped by regex (S3) and optionally
    snake-cased (S4).  With a schema its columns are taken by name and cast (a
    field that does not parse is NULL); a column that the file lacks is an error.
    Blanks are kept; an unquoted empty field is NULL."""
    # a quoted empty field is an empty string: marked on the way in, as only an unquoted one is NULL
    reader = spark.read.options(header=True, sep=sep, mode="PERMISSIVE", encoding="UTF-8", emptyValue=_EMPTY, **_CSV)
    df = (reader if schema is not None else reader.option("inferSchema", True)).csv(path)
    df = df.toDF(*[c.lstrip(BOM).strip() for c in df.columns])
    df = df.select(*[F.when(F.col(f"`{f.name}`") == _EMPTY, "").otherwise(F.col(f"`{f.name}`")).alias(f.name)
                     if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema])
    if drop_regex:
        df = drop_cols_regex(df, drop_regex)
    df = clean_names(df) if normalise_names else df
    if schema is None:
        return df
    lacking = [f.name for f in schema if f.name not in df.columns]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def write_listing(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited table with header that ``read_listing`` reads back unchanged."""
    df.write.mode("overwrite").options(header=True, sep=sep, **_CSV).csv(path)


def write_submission(pred: DataFrame, path: str, key: str = "ID", lo: str = "MIN", hi: str = "MAX") -> None:
    """``ID,MIN,MAX`` CSV with header (S5), written by the executors."""
    pred.select(F.col(key).alias("ID"), F.col(lo).alias("MIN"), F.col(hi).alias("MAX")).write.mode(
        "overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Persist split tables (S6), one directory per split value."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_results(results: DataFrame, path: str) -> None:
    """Experiment results (S8) as a long parquet table instead of a pickle."""
    results.write.mode("overwrite").parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory (never a
    machine-local temp folder)."""
    from ..session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/spanlab-io/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, *folders: str) -> None:
    """Removes folders of ``scratch_path`` that nothing reads any more."""
    for folder in folders:
        if "/spanlab-io/" not in folder:
            raise ValueError(f"not a scratch folder: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard_tables(*tables: DataFrame) -> None:
    """``discard`` of stored tables."""
    for t in tables:
        discard(t.sparkSession, *{f.rpartition("/")[0] for f in t.inputFiles()})
