"""Exact quantiles: global and grouped (distributed ranks) equal numpy's linear rule."""

import numpy as np

from spanlab.functions.stats import exact_quantiles, grouped_exact_quantiles


def test_grouped_exact_quantiles_hot_group(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(100, 20, 600).round(2)          # one group with most of the rows
    rows = [("hot", float(x)) for x in hot] + [("a", float(x)) for x in (1.0, 2.0, 2.0, 5.0)] + [("b", 7.0)]
    df = spark.createDataFrame(rows + [("a", None)], "g string, x double")
    probs = [0.1, 0.25, 0.5, 0.9]
    got = {r["g"]: r for r in grouped_exact_quantiles(df, "x", ["g"], probs, buckets=16).collect()}
    for g, vals in {"hot": hot, "a": np.array([1.0, 2.0, 2.0, 5.0]), "b": np.array([7.0])}.items():
        assert got[g]["n"] == len(vals)
        for i, p in enumerate(probs):
            assert abs(got[g][f"q{i}"] - float(np.quantile(vals, p))) < 1e-9


def test_exact_quantiles_global(spark):
    vals = [float(v) for v in np.random.default_rng(4).integers(0, 50, 301)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.05, 0.5, 0.95])
    assert all(abs(a - float(np.quantile(vals, p))) < 1e-9 for a, p in zip(got, [0.05, 0.5, 0.95]))


def test_quantiles_of_null_groups(spark):
    from spanlab.operators import profile

    rows = [(a, b, float(i)) for i, (a, b) in enumerate([("u", "v"), (None, "v"), ("u", None), (None, None)] * 50)] + [("w", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, y double")
    want = {}
    for a, b, y in rows:
        want.setdefault((a, b), []).extend([] if y is None else [y])
    got = {(r.a, r.b): r for r in profile.grouped_distribution(df, "y", "a", "b").collect()}
    assert got.keys() == want.keys()
    for k, ys in want.items():
        assert got[k].n == len(ys)
        assert [got[k].q25, got[k].q50, got[k].q75] == (np.quantile(ys, [0.25, 0.5, 0.75]).tolist() if ys else [None] * 3)
    letters = {(r.a, r.b, r.prob): (r.n, r.value) for r in profile.letter_values(df, "y", ["a", "b"]).collect()}
    assert letters[None, None, 0.5] == (50, float(np.median(want[None, None])))
