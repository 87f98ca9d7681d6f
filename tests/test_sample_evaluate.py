"""Splits, folds, weights, oversampling, metrics and interval repair."""

from collections import Counter

from pyspark.sql import functions as F

from spanlab.operators import evaluate, sample


def _ids(spark, n):
    return spark.range(1, n + 1).withColumnRenamed("id", "id")


def test_split_exact_sizes_and_disjoint(spark):
    df = _ids(spark, 101)
    s = sample.split_exact(df, 0.75, "id", seed=3).collect()
    c = Counter(r["split"] for r in s)
    assert c["train"] == round(0.75 * 101) and c["train"] + c["test"] == 101
    assert len({r["id"] for r in s}) == 101


def test_contiguous_fold_sizes(spark):
    df = _ids(spark, 13)
    f = sample.with_folds(df, 5, "id", shuffle=False).collect()
    sizes = Counter(r["fold"] for r in f)
    assert [sizes[i] for i in range(5)] == [3, 3, 3, 2, 2]
    first = sorted((r["id"], r["fold"]) for r in f)
    assert [fo for _, fo in first] == sorted(fo for _, fo in first)  # contiguous in key order


def test_shuffled_folds_each_id_once(spark):
    f = sample.with_folds(_ids(spark, 50), 5, "id", shuffle=True, seed=7).collect()
    assert len(f) == 50 and len({r["id"] for r in f}) == 50
    assert sorted(Counter(r["fold"] for r in f).values()) == [10] * 5


def test_weights_sum_to_one(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 300.0), (3, 600.0)], "id int, p double")
    for order in (0, 1, 2):
        total = sample.with_weights(df, "p", order).agg(F.sum("weight")).first()[0]
        assert abs(total - 1.0) < 1e-12


def test_oversample_overlapping_bands(spark):
    df = spark.createDataFrame([(1, 2300.0), (2, 1100.0), (3, 500.0), (4, 2000.0)], "id int, max_price double")
    c = Counter(r["id"] for r in sample.oversample(df).collect())
    assert c[1] == 1 + 10 + 10  # > 2000 and [2200, 2400]
    assert c[2] == 1 + 2 and c[3] == 1 and c[4] == 1 + 1  # 2000 is in [1200, 2000] only


def test_repair_idempotent_and_null_kept(spark):
    df = spark.createDataFrame([(1, 5.0, 3.0), (2, 1.0, 2.0), (3, None, 4.0)], "ID int, MIN double, MAX double")
    once = evaluate.repair_intervals(df)
    twice = evaluate.repair_intervals(once)
    assert sorted(once.collect()) == sorted(twice.collect())
    got = {r["ID"]: (r["MIN"], r["MAX"]) for r in once.collect()}
    assert got == {1: (3.0, 5.0), 2: (1.0, 2.0), 3: (None, 4.0)}
    assert evaluate.inverted_intervals(once).count() == 0


def test_interval_mae(spark):
    df = spark.createDataFrame([(10.0, 20.0, 12.0, 19.0), (0.0, 5.0, 0.0, 8.0)],
                               "min_price double, max_price double, MIN double, MAX double")
    r = evaluate.interval_mae(df).first()
    assert r["mae_min"] == 1.0 and r["mae_max"] == 2.0 and r["mae_total"] == 3.0
    assert evaluate.interval_mae_flat(df).first()[0] == 3.0
