"""Boundary values of the derived features (FIXTURES §5 edges_*)."""

from pyspark.sql import functions as F

from spanlab.operators import clean, features


def _one(df, col):
    return {r[0]: r[1] for r in df.collect()} if col is None else [r[col] for r in df.collect()]


def test_ssd_bands(spark):
    vals = [0, 1, 63, 64, 256, 257, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, ssd int")
    got = {r["id"]: r["ssd_category"] for r in features.ssd_category(df).collect()}
    assert [got[i] for i in range(len(vals))] == ["none", "small", "small", "medium", "medium", "large", "large"]


def test_storage_bands(spark):
    vals = [0, 1, 256, 257, 1028, 1029, 2056, 2057, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, storage int")
    got = {r["id"]: r["storage_category"] for r in features.storage_category(df).collect()}
    assert [got[i] for i in range(len(vals))] == ["none", "small", "small", "medium", "medium", "large", "large",
                                                  "very large", "very large"]


def test_hd_classes(spark):
    rows = [(0, 1366, 768), (1, 1600, 900), (2, 1920, 1080), (3, 2560, 1440), (4, 3840, 2160), (5, 2304, 1440),
            (6, 1199, 700), (7, None, None)]
    df = spark.createDataFrame(rows, "id int, pixels_x int, pixels_y int")
    got = {r["id"]: r["hd_resolution_category"] for r in features.hd_category(df).collect()}
    assert got[1] == "hd" and got[2] == "fullhd" and got[3] == "qhd/uhd" and got[4] == "4k"
    assert got[5] == "retina" and got[6] == "sd" and got[7] == "sd"


def test_cpu_frequency_strict_and_compat(spark):
    vals = ["2.5 GHz", "1.80GHz", "2400 GHz", "3 GHz", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, cpu_details string")
    strict = {r["id"]: r["cpu_frequency"] for r in features.cpu_frequency(df).collect()}
    compat = {r["id"]: r["cpu_frequency"] for r in features.cpu_frequency(df, strict=False).collect()}
    assert strict[0] == 2.5 and abs(strict[1] - 1.8) < 1e-12
    assert strict[4] is None and strict[5] is None
    assert compat[2] == 2400 + 400  # the wildcard-dot quirk of the compat mode


def test_blank_to_null_and_surface(spark):
    df = spark.createDataFrame([(1, " "), (2, "matte"), (3, None), (4, "Glossy")], "id int, screen_surface string")
    got = {r["id"]: r["screen_surface"] for r in clean.fix_surface(df).collect()}
    assert got == {1: None, 2: "Matte", 3: None, 4: "Glossy"}


def test_drop_wide_spread_keeps_null(spark):
    df = spark.createDataFrame([(1, 100.0, 500.0), (2, 100.0, 500.01), (3, None, 10.0)],
                               "id int, min_price double, max_price double")
    assert sorted(r["id"] for r in clean.drop_wide_spread(df).collect()) == [1, 3]


def test_lump_rare_keep_force_unseen(spark):
    rows = [("a",)] * 8 + [("b",)] * 9 + [("c",)] * 10 + [("k",)] * 2
    train = spark.createDataFrame(rows, "brand string")
    m = features.fit_lump_rare(train, "brand", min_count=9, keep=["k"], force=["c"])
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("k",), ("new",)], "brand string")
    got = [r["brand"] for r in m.transform(test).orderBy(F.col("brand")).collect()]
    assert sorted(got) == sorted(["Other1", "b", "Other1", "k", "new"])
