"""Interval models, tuning tables and the driver contract."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from spanlab.operators import evaluate
from spanlab.operators import models as M
from spanlab.operators import tune as T
from spanlab.sources import fixtures as fx

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_and_catalogue(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "mae_total" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 150


def test_forest_beats_mean_and_transform_roundtrip(spark):
    df = fx.listing(spark, SF_SMALL)
    tr, te = df.filter(F.col("id") % 4 != 0), df.filter(F.col("id") % 4 == 0)
    m = M.fit_interval_model(tr, "rf", params={"numTrees": 20, "maxDepth": 6}, target="log")
    pred = M.with_truth(m.transform(te), te)
    mae = evaluate.interval_mae(pred).first()["mae_total"]
    means = tr.agg(F.avg("min_price"), F.avg("max_price")).first()
    base = te.select("min_price", "max_price", F.lit(means[0]).alias("MIN"), F.lit(means[1]).alias("MAX"))
    assert mae < evaluate.interval_mae(base).first()["mae_total"]
    tt = M.TargetTransform("yeo-johnson").fit(tr, ["max_price"])
    rt = tr.select("max_price", tt.inverse(tt.forward("max_price"), "max_price").alias("back"))
    assert rt.filter(F.abs(F.col("back") - F.col("max_price")) > 1e-6).count() == 0


def test_cv_table_shape_and_oof_cover(spark):
    df = fx.listing(spark, SF_SMALL)
    res = T.cross_validate(df, "tree", [{"maxDepth": 2}, {"maxDepth": 4}], k=3)
    assert res.count() == 6 and res.filter(F.col("mae") < 0).count() == 0
    oof = T.oof_predictions(df, "tree", {"maxDepth": 3}, k=3)
    assert oof.count() == df.count() and oof.select("id").distinct().count() == df.count()


def test_adaboost_weighted_median(spark):
    df = spark.createDataFrame([([1.0, 5.0, 3.0],), ([2.0, 2.0, 9.0],)], "p array<double>")
    got = [r[0] for r in df.select(M.weighted_median(F.col("p"), [1.0, 1.0, 3.0])).collect()]
    assert got == [3.0, 9.0]


def test_pca_features_width(spark):
    from pyspark.ml.functions import vector_to_array

    df = fx.listing(spark, SF_SMALL)
    a = M.pca_features(df, df, k=5).select(F.size(vector_to_array("features_pca")).alias("n")).first()["n"]
    both = M.pca_features(df, df, k=5, keep_original=True)
    b = both.select(F.size(vector_to_array("features_pca")).alias("n")).first()["n"]
    w = both.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    assert a == 5 and b == w + 5


def test_keys_ask_for_the_whole_job(spark, monkeypatch):
    """Folds, configurations, splits, seeds and repeats of the registered keys, seen where the work is given out."""
    import inspect

    from spanlab.plans import catalog_ml as ML

    class Asked(Exception):
        pass

    def asked(key, name, module=ML.T):
        real = getattr(module, name)

        def catch(*a, **kw):
            b = inspect.signature(real).bind(*a, **kw)
            b.apply_defaults()
            raise Asked(b.arguments)
        with monkeypatch.context() as m:
            m.setattr(module, name, catch)
            m.setattr(ML.M, "fit_interval_model", lambda *a, **kw: None)
            try:
                getattr(ML, f"q_{key}")(spark, "/root/testdata/sf0.001")
            except Asked as e:
                return e.args[0]

    for key, n, name in (("random_search", 120, "forest_cross_validate"), ("grid_search", 12, "boost_cross_validate"), ("halton_search", 20, "cross_validate"),
                         ("cv_curve", 32, "forest_cross_validate")):
        got = asked(key, name)
        assert (len(got["configs"]), got["k"]) == (n, 5), key
    assert asked("stacking", "fit_stacking")["k"] == 5
    assert len(asked("coef_path", "elastic_net_path", ML.LN)["lambdas"]) == 100
    got = asked("learning_curve", "forest_learning_curve")
    assert (len(got["sizes"]), got["splits"], got["test"]) == (5, 50, 0.2)
    assert len(asked("model_comparison_runs", "model_comparison")["seeds"]) == 5
    got = asked("permutation_importance", "permutation_importance")
    assert (len(got["features"]), got["repeats"]) == (15, 10)


def test_learning_curve_over_splits(spark):
    from spanlab.operators import tune
    from spanlab.plans.catalog import L

    rows = tune.learning_curve(L(spark, "/root/testdata/sf0.001"), "tree", {"maxDepth": 2}, sizes=(1.0,), splits=2).collect()
    n = L(spark, "/root/testdata/sf0.001").count()
    assert [r.fold for r in rows] == [0, 1] and all(r.n_train == n - -(-n // 5) for r in rows)


def test_crossvalidator_key_makes_the_listing_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from spanlab.operators import models as M
    from spanlab.plans import catalog_ml as CM
    from spanlab.plans import registry

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(60).select("id", (F.col("id") * 3.0 + 5).alias("max_price"), *[((F.col("id") * (i + 2)) % 7).cast("double").alias(c) for i, c in enumerate(M.NUMERIC)],
                                *[F.concat(F.lit("l"), F.col("id") % (i + 2)).alias(c) for i, c in enumerate(M.CATEGORICAL)])
    df = df.mapInArrow(counted, df.schema)
    monkeypatch.setattr(CM, "L", lambda spark, sf: df)
    assert registry.queries()["crossvalidator_interval"](spark, "").count() == 3
    assert 60 <= made.value <= 180  # once, and for the ranks of the folds; not for each fold, depth and fit
