"""Delimited reader: semicolons, UTF-8 BOM on the first header name, junk columns."""

from spanlab.sources import io


def test_read_semicolon_bom_and_junk(spark):
    path = io.scratch_path(spark, "bom-csv")
    lines = ["﻿id;Unnamed: 0;brand;max_price", "1;0;a;10.5", "2;1;b;"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    df = io.read_listing(spark, path, sep=";", schema=None)
    assert df.columns == ["id", "brand", "max_price"]
    rows = sorted((r["id"], r["brand"], r["max_price"]) for r in df.collect())
    assert rows == [(1, "a", 10.5), (2, "b", None)]


def test_submission_roundtrip(spark):
    pred = spark.createDataFrame([(1, 2.0, 3.0), (2, 5.0, 4.0)], "ID long, MIN double, MAX double")
    path = io.scratch_path(spark, "sub")
    io.write_submission(pred, path)
    back = spark.read.option("header", True).schema("ID long, MIN double, MAX double").csv(path)
    assert sorted(back.collect()) == sorted(pred.collect())
