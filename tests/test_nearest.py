"""Nearest rows with missing values and factors against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlab.operators import impute
from spanlab.operators import nearest as N

NAN = float("nan")


def _brute(queries, refs, k, factor, power):
    out = {}
    for q, x in queries:
        found = []
        for r, y in refs:
            both = [i for i in range(len(factor)) if not (math.isnan(x[i]) or math.isnan(y[i]))]
            if both:
                v = sum((x[i] != y[i]) if factor[i] else abs(x[i] - y[i]) ** power for i in both) * len(factor) / len(both)
                found.append((round(v, 9), r))
        out[q] = sorted(found)[:k]
    return out


@pytest.mark.parametrize("power,kind", [(2, "long"), (1, "long"), (1, "string")])
def test_nearest_equals_all_pairs(spark, power, kind):
    rng = np.random.default_rng(power)
    factor = [False, False, True, False, True]

    def rows(n, off):
        out = []
        for i in range(n):
            v = [float(rng.integers(0, 9)), float(np.round(rng.normal(), 2)), float(rng.integers(0, 4)), float(rng.integers(0, 3)), float(rng.integers(0, 30))]
            v = [NAN if rng.random() < 0.25 else x for x in v]
            out.append((off + i if kind == "long" else f"k{(off + i) * 7919 % 1000:03d}", v))
        return out
    refs, queries = rows(400, 0) + [((10_000 + i) if kind == "long" else f"z{i}", [1.0, NAN, 2.0, NAN, NAN]) for i in range(40)], rows(60, 500) + [((900 if kind == "long" else "q900"), [NAN] * 5)]
    queries += [((1000 + i) if kind == "long" else f"same{i}", queries[0][1]) for i in range(50)]
    schema = f"id {kind}, vec array<double>"
    got = {}
    for r in N.nearest(spark.createDataFrame(queries, schema), spark.createDataFrame(refs, schema), 4, factor, power, leaf_rows=10).collect():
        got.setdefault(r["id"], []).append((r["rank"], round(r["value"], 9), r["nbr"]))
    want = _brute(queries, refs, 4, factor, power)
    for q, x in queries:
        mine = sorted(got.get(q, []))
        assert [n for _, _, n in mine] == [n for _, n in want[q]] and [v for _, v, _ in mine] == pytest.approx([v for v, _ in want[q]])
    assert got.get(900 if kind == "long" else "q900") is None


def test_nearest_empty_sides_and_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [NAN, 2.5])], "id long, vec array<double>")
    assert N.nearest(df.limit(0), df, 3, [False] * 2).count() == 0
    assert N.nearest(df, df.limit(0), 3, [False] * 2).count() == 0
    assert N.nearest(df, df, 3, [False] * 2).count() == 4


def test_knn_fills_from_donors_that_lack_a_feature(spark):
    rows = [(1, 1.0, 1.0, 10.0), (2, None, 1.1, 20.0), (3, 5.0, 5.0, 90.0), (4, 1.0, 1.0, None), (5, None, 5.0, None), (6, None, None, None), (7, NAN, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    got = {r["id"]: r["y"] for r in impute.fit_knn(df, "y", ["a", "b"], k=1).transform(df).collect()}
    assert got == {1: 10.0, 2: 20.0, 3: 90.0, 4: 10.0, 5: 90.0, 6: 40.0, 7: 10.0}
    none = df.withColumn("y", F.lit(None).cast("double"))
    assert [r["y"] for r in impute.fit_knn(none, "y", ["a", "b"], k=1).transform(none).collect()] == [None] * 7


def test_gower_leaves_out_what_is_missing(spark):
    rows = [(1, 0.0, "a", None, "L"), (2, 10.0, "b", "p", "M"), (3, 0.0, None, "q", "S"), (4, 0.0, "a", "q", None), (5, None, "b", None, None), (6, None, "new", None, None), (7, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, x double, f string, g string, os string")
    m = impute.fit_knn_nominal(df, "os", ["x"], ["f", "g"], k=1)
    near = {r["id"]: (r["nbr"], r["dist"]) for r in m.neighbours(df).collect()}
    assert near == {4: (1, 0.0), 5: (2, 0.0), 6: (1, 1.0)}  # row 4 matches 1 in all they share, and 3; the smaller key is first
    assert {r["id"]: r["os"] for r in m.transform(df).collect()} == {1: "L", 2: "M", 3: "S", 4: "L", 5: "M", 6: "L", 7: "L"}


def test_knn_columns_fill_from_the_rows_as_they_were(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *[None if rng.random() < 0.2 else float(rng.integers(0, 20)) for _ in range(3)]) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r["id"]: r for r in impute.fit_knn_columns(df, ["a", "b", "c"], 3).transform(df).collect()}
    vec = {r[0]: [NAN if v is None else v for v in r[1:]] for r in rows}
    for j, c in enumerate("abc"):
        donors = [(i, v) for i, v in vec.items() if not math.isnan(v[j])]
        rest = [x for x in range(3) if x != j]
        want = _brute([(i, [v[x] for x in rest]) for i, v in vec.items() if math.isnan(v[j])], [(i, [v[x] for x in rest]) for i, v in donors], 3, [False] * 2, 2)
        for i, near in want.items():
            fill = np.mean([vec[n][j] for _, n in near]) if near else np.mean([v[j] for _, v in donors])
            assert got[i][c] == pytest.approx(fill)


def test_driver_holds_numbers_not_objects(spark):
    """samples, boxes and trees were Python objects on the driver, four searches at a time."""
    import numpy as np

    from spanlab.operators import nearest as N

    df = spark.createDataFrame([(i % 3, [float(i), float("nan")], [1.0, float(-i)]) for i in range(40)], "a int, u array<double>, v array<double>").repartition(3)
    got = N._packed(df, ["u", "v"], 2)
    assert sorted(v for a, _, _ in got for v in a.tolist()) == sorted(i % 3 for i in range(40))
    assert sorted((u[0], v[1]) for _, us, vs in got for u, v in zip(us.tolist(), vs.tolist())) == [(float(i), float(-i)) for i in range(40)]
    assert N._packed(df.limit(0), ["u", "v"], 2) == [] or all(len(a) == 0 for a, _, _ in N._packed(df.limit(0), ["u", "v"], 2))
    tree = N._build(np.random.default_rng(0).random((500, 4)), np.arange(4), np.zeros(4, bool), 8.0)
    size = sum(v.nbytes for v in vars(tree).values())
    assert len(tree.left) > 60 and size <= len(tree.left) * (2 * 4 * 8 + 20)
