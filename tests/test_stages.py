"""Pipeline stages, selectors, metric set."""

from pyspark.ml import Pipeline

from spanlab.operators import stages as ST


def test_selectors(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3.0)], "id long, brand string, screen_size double, max_price double")
    roles = {"id": "id", "max_price": "outcome"}
    assert ST.all_numeric(df, exclude=["id"]) == ["screen_size", "max_price"]
    assert ST.all_nominal(df) == ["brand"]
    assert ST.all_outcomes(roles) == ["max_price"]
    assert ST.all_predictors(df, roles) == ["brand", "screen_size"]


def test_stage_pipeline_matches_functions(spark):
    df = spark.createDataFrame([(1, "glossy", 1920, 1080, 128, 1000, "i5 2.5 GHz"), (2, " ", 3840, 2160, 0, 0, None)],
                               "id int, screen_surface string, pixels_x int, pixels_y int, ssd int, storage int, "
                               "cpu_details string")
    out = Pipeline(stages=[ST.SurfaceFixer(), ST.HdCategorizer(), ST.SizeCategorizer("ssd"),
                           ST.SizeCategorizer("storage"), ST.CpuFrequencyExtractor()]).fit(df).transform(df)
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["screen_surface"] == "Glossy" and got[2]["screen_surface"] is None
    assert got[1]["hd_resolution_category"] == "fullhd" and got[2]["hd_resolution_category"] == "4k"
    assert got[1]["ssd_category"] == "medium" and got[2]["storage_category"] == "none"
    assert got[1]["cpu_frequency"] == 2.5 and "cpu_details" not in out.columns


def test_metric_set(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "t double, p double")
    r = ST.metric_set(df, "t", "p").first()
    assert r["mae"] == 0.5 and abs(r["rmse"] - 0.5 ** 0.5) < 1e-12
