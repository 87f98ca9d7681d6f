"""Empty, constant, tied and jointly missing inputs; whole-model save and load; CSV by header name."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlab.functions.stats import exact_quantiles, exact_quantiles_many
from spanlab.operators import encode, evaluate, impute, models, neighbors, profile, scale
from spanlab.sources import io


@pytest.fixture(scope="module")
def frames(spark):
    schema = "id long, a double, b double, c double, s string"
    return {
        "empty": spark.createDataFrame([], schema),
        "nulls": spark.createDataFrame([(i, None, None, None, None) for i in range(5)], schema),
        "constant": spark.createDataFrame([(i, 2.0, float(i), 2.0, "x") for i in range(20)], schema),
    }


@pytest.mark.parametrize("kind", ["empty", "nulls", "constant"])
def test_summaries_of_degenerate_columns(frames, kind):
    df, cols = frames[kind], ["a", "b", "c"]
    for out in (profile.describe_numeric(df, cols), profile.corr_matrix(df, cols), profile.histogram_auto(df, "a"), profile.boxplot_stats(df, "a"),
                profile.kde_binned(df, "a"), profile.profile_numeric(df, cols), profile.profile_alerts(df, cols, ["s"]),
                profile.letter_values(df, "a", ["s"]), encode.near_zero_variance(df.select("a", "b", "s")),
                evaluate.regression_metrics(df, "a", "b"), evaluate.interval_mae_flat(df, ("a", "b"), ("c", "c"))):
        out.collect()
    for fit in (scale.fit_min_max, scale.fit_robust, scale.fit_standardize, impute.fit_median, impute.fit_mode):
        fit(df, cols).transform(df).collect()


def test_constant_alert_and_correlation(frames):
    df = frames["constant"]
    corr = {(r.var_a, r.var_b): r.corr for r in profile.corr_matrix(df, ["a", "b"]).collect()}
    assert corr["a", "b"] is None and corr["a", "a"] == 1.0
    alerts = {(r.column, r.alert) for r in profile.profile_alerts(df, ["a", "b"], ["s"]).collect()}
    assert ("a", "constant") in alerts and ("s", "constant") in alerts
    assert evaluate.regression_metrics(df, "a", "b").first().rsq is None


def test_quantiles_with_a_hot_value(spark):
    vals = [7.25] * 4000 + [float(x) for x in np.random.default_rng(1).lognormal(2, 1, 2000)]
    df = spark.createDataFrame([(v, -v) for v in vals], "x double, y double").repartition(7)
    probs = [0.0, 0.05, 0.3, 0.5, 0.9, 1.0]
    got = exact_quantiles_many(df, ["x", "y"], probs, buckets=16)
    assert np.allclose(got["x"], np.quantile(vals, probs)) and np.allclose(got["y"], np.quantile([-v for v in vals], probs))
    assert exact_quantiles(df, "x", [0.5]) == [7.25]


def test_hot_value_keeps_all_qq_points(spark, monkeypatch):
    monkeypatch.setattr(profile, "QQ_PIECE", 50)
    df = spark.createDataFrame([(1.0,)] * 400 + [(float(i),) for i in range(100)], "x double")
    rows = sorted((r.i, r.sample) for r in profile.qq_points(df, "x").collect())
    assert [i for i, _ in rows] == list(range(1, 501)) and [s for _, s in rows] == sorted(s for _, s in rows)


def test_near_zero_variance_with_tied_levels(spark):
    rows = [("p", "x")] * 1000 + [("q", "x")] * 1000 + [("r", "y")]
    got = {r["column"]: r for r in encode.near_zero_variance(spark.createDataFrame(rows, "t string, u string")).collect()}
    assert got["t"].freq_ratio == 1.0 and not got["t"].nzv
    assert got["u"].freq_ratio == 2000.0 and got["u"].nzv


def test_regression_imputation_of_values_missing_together(spark):
    rows = [(i, float(i), 2.0 * i + (i % 3), 3.0 * i - (i % 5)) for i in range(1, 60)]
    rows += [(100 + i, float(i), None, None) for i in (12, 24)] + [(200, 30.0, None, 90.0), (201, 30.0, 60.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = impute.fit_regression_impute(df, ["a", "b", "c"])
    got = {r.id: r for r in model.transform(df).collect()}
    for i, a in ((112, 12.0), (124, 24.0)):
        assert abs(got[i].b - (2 * a + 1)) < 1.5 and abs(got[i].c - (3 * a - 2)) < 2.5
    assert abs(got[200].b - 61) < 2 and abs(got[201].c - 88) < 3
    # fills agree with each other: running the last regressions over them changes nothing
    for i in (112, 124):
        for t in ("b", "c"):
            b0, betas = model.coefs[t]
            assert abs(got[i][t] - (b0 + sum(b * got[i][x] for x, b in betas.items()))) < 1e-3


def test_lambda_outside_the_first_bracket(spark):
    x = np.linspace(0.05, 1.0, 400) ** (1 / 5.0)
    df = spark.createDataFrame([(float(v * 3),) for v in x], "x double")
    assert scale.fit_power(df, ["x"], "box-cox").lambdas["x"] > 3.5


def test_components_of_a_long_chain(spark):
    nodes = spark.range(301)
    edges = spark.range(300).select("id", (F.col("id") + 1).alias("nbr"))
    assert neighbors.connected_components(edges, nodes).select("label").distinct().count() == 1


@pytest.mark.parametrize("target", ["none", "log", "log-standardize", "yeo-johnson"])
def test_saved_model_predicts_the_same(spark, target):
    rows = [(i, float(i % 17), "ab"[i % 2], 100.0 + 3 * i, 150.0 + 5 * i) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, w double, k string, min_price double, max_price double")
    m = models.fit_interval_model(df, "tree", numeric=["w"], categorical=["k"], target=target, params={"maxDepth": 3})
    path = io.scratch_path(spark, "model")
    m.save(path)
    back = models.load_interval_model(path)
    assert sorted(map(tuple, back.transform(df).collect())) == sorted(map(tuple, m.transform(df).collect()))
    with pytest.raises(ValueError):
        models.estimator("tree", "y", maxDepth=40)


def test_csv_by_header_name_and_blanks(spark):
    df = spark.createDataFrame([(1, " ", "a;\"b\"", 1.5), (2, None, "", 2.0), (3, " x ", "é", None)], "id long, name string, brand string, weight double")
    path = io.scratch_path(spark, "csv")
    io.write_listing(df.select("brand", "weight", "id", "name"), path, sep=";")
    back = io.read_listing(spark, path, sep=";", schema=df.schema)
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        io.read_listing(spark, path, sep=";", schema=io.LISTING_SCHEMA)


def test_polynomial_features_keep_all_rows(frames):
    assert models.polynomial_features(frames["nulls"], ["a", "b"]).count() == 5


def test_ranks_of_string_keys_and_ties(spark):
    from spanlab.functions.ranking import ordered_rank, value_ranks
    from spanlab.operators.sample import with_folds

    names = [f"k{i * 7919 % 1000:04d}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "id string")
    got = {r.id: r["rank"] for r in ordered_rank(df, "id").collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}
    ties = spark.createDataFrame([(v,) for v in [3.0, 1.0, 3.0, 2.0, 3.0, None]], "x double")
    assert sorted(map(tuple, value_ranks(ties, "x").collect())) == [(1.0, 0, 1), (2.0, 1, 1), (3.0, 2, 3)]
    sizes = [r["count"] for r in with_folds(df, 5).groupBy("fold").count().collect()]
    assert sizes == [60] * 5
