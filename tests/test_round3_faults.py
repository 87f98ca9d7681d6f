"""Faults found by probing: names, levels, metrics with a missing side, empty frames, outliers, string keys."""

import pytest
from pyspark.sql import functions as F

from spanlab.operators import clean, encode, evaluate, neighbors, profile, sample


def test_clean_names_are_unique(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["A b", "a_b", "a_b_2", "a b"])
    assert clean.clean_names(df).columns == ["a_b", "a_b_2", "a_b_2_2", "a_b_3"]


def test_levels_of_numbers_clashing_names_and_widths(spark):
    df = spark.createDataFrame([(1, 5, "x"), (2, None, "y"), (3, 7, None), (4, 5, "z")], "id long, n int, __level string")
    lv = encode.level_table(df.filter("id < 4"), ["n", "__level"])
    assert sorted(map(tuple, lv.collect())) == [("__level", "x", 0), ("__level", "y", 1), ("n", "5", 0), ("n", "7", 1)]
    out = {r["id"]: (r["n"], r["__level"]) for r in encode.novel_unknown(df, lv).collect()}
    assert out == {1: ("5", "x"), 2: ("unknown", "y"), 3: ("7", "unknown"), 4: ("5", "new")}
    assert {r["id"]: (r["n"], r["__level"]) for r in encode.ordinal_encode(df, lv).collect()} == {1: (0, 0), 2: (None, 1), 3: (1, None), 4: (0, None)}
    many = spark.range(3000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c")).repartition(5)
    got = encode.level_table(many, ["c"])
    assert got.filter(F.substring("level", 2, 6).cast("int") != F.col("slot")).count() == 0 and got.count() == 3000
    with pytest.raises(ValueError, match="3000 levels"):
        encode.fit_levels(many, ["c"], max_levels=100)


def test_flat_interval_mae_is_the_interval_mae(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0, None), (1.0, 5.0, 4.0, 8.0), (None, 1.0, 1.0, 2.0)], "min_price double, max_price double, MIN double, MAX double")
    assert evaluate.interval_mae_flat(df).first()[0] == evaluate.interval_mae(df).first()["mae_total"]


def test_empty_frames_and_outliers(spark):
    none = spark.createDataFrame([], "id long, a double, b double, g string")
    assert profile.pair_bins(none, ["a", "b"]).count() == 0
    assert profile.qq_points(none, "a").count() == 0
    assert sample.with_weights(none, "a", 0).count() == 0
    assert profile.fixed_bins(none, "a", by=["g"]).columns[0] == "g"
    wild = spark.range(1000).select((F.col("id") % 7 + F.when(F.col("id") == 3, 1e14).otherwise(0)).cast("double").alias("a"))
    with pytest.raises(ValueError, match="max_bins"):
        profile.histogram_auto(wild, "a")


def test_neighbours_of_string_keys(spark):
    rows = [(f"k{i}", [float(i % 9), float(i % 5)]) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, vec array<double>")
    got = {(r["id"], r["rank"]): r["nbr"] for r in neighbors.knn_dense(df, 3).collect()}
    for k, v in rows[:20]:
        near = sorted((round(sum((a - b) ** 2 for a, b in zip(v, w)), 9), o) for o, w in rows if o != k)[:3]
        assert [got[(k, r)] for r in (1, 2, 3)] == [o for _, o in near]


def test_union_of_bands_reads_the_view_once(spark, tmp_path):
    """five bands over one joined view had a task read all five of a partition."""
    from pyspark.sql import functions as F
    from spanlab.plans import registry
    from spanlab.sources import fixtures as fx

    sf = str(tmp_path)
    ids = spark.range(1, 801)
    ids.selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "concat('Brand#', id % 5) AS p_brand", "concat('TYPE ', id % 7) AS p_type",
                   "cast(id % 50 AS int) AS p_size", "cast(900 + 9 * id AS double) AS p_retailprice").write.parquet(f"{sf}/part.parquet")
    ids.crossJoin(spark.range(3).withColumnRenamed("id", "r")).selectExpr("id AS l_partkey", "cast(1000 + 13 * id + 100 * r AS double) AS l_extendedprice").write.parquet(f"{sf}/lineitem.parquet")
    out = registry.queries()["union_all_bands"](spark, sf)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Join" not in plan
    got = {r["band"]: r["count"] for r in out.groupBy("band").count().collect()}
    price = [r[0] for r in fx.listing(spark, sf).select(F.col("max_price")).collect()]
    want = {"gt2000": sum(p > 2000 for p in price), "b2200_2400": sum(2200 <= p <= 2400 for p in price), "b2600_3000": sum(2600 <= p <= 3000 for p in price),
            "b1200_2000": sum(1200 <= p <= 2000 for p in price), "b1000_1200": sum(1000 <= p <= 1200 for p in price)}
    assert got == {b: n for b, n in want.items() if n} and len(got) > 2


def test_oof_predictions_store_the_folds(spark):
    """every fold's fit and prediction ranked the rows and dealt the folds anew."""
    from spanlab.operators import tune

    df = spark.range(120).select("id", (F.col("id") * 3.0).alias("max_price"), *[(F.col("id") % 17).cast("double").alias(c) for c in tune.M.NUMERIC],
                                 *[F.concat(F.lit("v"), F.col("id") % 2).alias(c) for c in tune.M.CATEGORICAL])
    out = tune.oof_predictions(df, "tree", {"maxDepth": 2}, k=4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Window" not in plan
    got = out.collect()
    assert sorted(r["id"] for r in got) == list(range(120)) and {r["fold"] for r in got} == set(range(4))
    assert all(r["truth"] == r["id"] * 3.0 for r in got)


def test_permuted_rows_send_values_not_rows(spark):
    """Each copy has one column permuted by its draw; the rows as they are come once, not once a repeat."""
    from spanlab.operators import tune

    n, repeats = 50, 4
    df = spark.range(n).select("id", F.col("id").cast("double").alias("a"), F.concat(F.lit("s"), "id").alias("g"), (F.col("id") * 3.0).alias("y"))
    df = df.withColumn("a", F.when(F.col("id") != 7, F.col("a")))
    ranked = df.withColumn("__rank", F.col("id"))
    got = tune._permuted(ranked, ["a", "g"], n, repeats, 1).collect()
    assert len(got) == 2 * repeats * n
    for i, c in enumerate(["a", "g"]):
        for rep, (a, b) in enumerate(tune._draws(n, repeats, f"1:{c}")):
            for r in (r for r in got if r["feature"] == c and r["rep"] == rep):
                other = (a * r["id"] + b) % n
                assert r[c] == ((None if other == 7 else float(other)) if c == "a" else f"s{other}")
                assert r["y"] == 3.0 * r["id"] and r["g" if c == "a" else "a"] == (f"s{r['id']}" if c == "a" else None if r["id"] == 7 else float(r["id"]))

    seen = []

    class Guess:
        labels = ("y",)

        def transform(self, rows, key, keep):
            seen.append(rows)
            return rows.select(F.col(key).alias("ID"), *keep, (F.coalesce("a", F.lit(0.0)) * 3.0).alias("pred_y"))

    out = {r["feature"]: r for r in tune.permutation_importance(Guess(), df, ["a", "g"], repeats, 1).collect()}
    assert seen[0].filter("feature = '__none__'").count() == n
    assert out["a"]["importance_mean"] > 0.3 and abs(out["g"]["importance_mean"]) < 1e-9
