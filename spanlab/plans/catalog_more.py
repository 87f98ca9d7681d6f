"""Catalogue, part 2: encoding, scaling, power transforms, sampling, joins and
ranking, profiling, and the aggregation side of tuning (SURVEY §2.5-§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.ranking import value_ranks
from ..operators import encode, evaluate, profile, relate, sample, scale
from ..session import cut_lineage
from ..sources import fixtures as fx
from . import sqltext as S
from .catalog import LISTING, L, _train, _train_cte, register

TRAIN = _train_cte()


def r6(c):
    return C.r6(c).alias(c)


def z(c):
    """Round to 6 decimals and drop the sign of zero."""
    return (F.round(F.col(c), 6) + F.lit(0.0)).alias(c)


# ---------------------------------------------------------------------------
# Encoding (E1-E4, E9)
# ---------------------------------------------------------------------------
OHE_COLS = ["brand", "cpu", "os"]


def _levels_sql(cols, src="train"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, {c} AS level, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS slot "
        f"FROM (SELECT DISTINCT {c} FROM {src} WHERE {c} IS NOT NULL)" for c in cols)


@register("one_hot_long", "SELECT l.id, lv.col_name, lv.level, lv.slot FROM listing l JOIN lv ON "
          + " OR ".join(f"(lv.col_name = '{c}' AND l.{c} = lv.level)" for c in OHE_COLS),
          ctes={**TRAIN, "lv": _levels_sql(OHE_COLS)})
def q_one_hot_long(spark, sf):
    df = L(spark, sf)
    levels = encode.level_table(_train(df), OHE_COLS)
    return encode.one_hot_long(levels, df.select("id", *OHE_COLS), OHE_COLS).withColumnRenamed("column", "col_name")


DUMMY_COLS = ["brand", "cpu"]


@register("dummies_drop_first")
def q_dummies_drop_first(spark, sf):
    df = L(spark, sf)
    levels = encode.fit_levels(_train(df), DUMMY_COLS)
    return encode.dummies_drop_first(df.select("id", *DUMMY_COLS), levels)


@register("dummies_long", "SELECT l.id, concat('DM_', lv.col_name, '_', lv.level) AS dummy, CASE WHEN "
          + " OR ".join(f"(lv.col_name = '{c}' AND l.{c} = lv.level)" for c in DUMMY_COLS) + " THEN 1 ELSE 0 END AS value "
          "FROM listing l CROSS JOIN lv WHERE lv.slot > 0", ctes={**TRAIN, "lv": _levels_sql(DUMMY_COLS)})
def q_dummies_long(spark, sf):
    """The dummy columns by value: (id, dummy, value), the first level of a column left out."""
    df = L(spark, sf)
    wide = encode.dummies_drop_first(df.select("id", *DUMMY_COLS), encode.fit_levels(_train(df), DUMMY_COLS))
    return wide.unpivot(["id"], [f"`{c}`" for c in wide.columns if c != "id"], "dummy", "value")


@register("novel_unknown", """
, lv AS (SELECT DISTINCT os FROM train WHERE os IS NOT NULL AND os <> 'Chrome OS')
SELECT id, CASE WHEN os IS NULL THEN 'unknown' WHEN os NOT IN (SELECT os FROM lv) THEN 'new' ELSE os END AS os
FROM listing""", ctes=TRAIN)
def q_novel_unknown(spark, sf):
    df = L(spark, sf)
    levels = encode.level_table(_train(df).filter(F.col("os") != "Chrome OS"), ["os"])
    return encode.novel_unknown(df.select("id", "os"), levels)


@register("ordinal_encode", """
, lv AS (SELECT cpu, CAST(row_number() OVER (ORDER BY cpu) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT cpu FROM train WHERE cpu IS NOT NULL))
SELECT l.id, lv.code AS cpu FROM listing l LEFT JOIN lv ON l.cpu = lv.cpu""", ctes=TRAIN)
def q_ordinal_encode(spark, sf):
    df = L(spark, sf)
    levels = encode.level_table(_train(df), ["cpu"])
    return encode.ordinal_encode(df.select("id", "cpu"), levels)


NZV_COLS = ["touchscreen", "detachable_keyboard", "discrete_gpu", "ram", "ssd", "storage", "os", "screen_surface"]


def _nzv_sql(cols, freq_cut):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS col_name, m1, m2, n_unique FROM (
  SELECT max(cnt) AS m1, count(*) AS n_unique, max(cnt) FILTER (WHERE place = 2) AS m2
  FROM (SELECT count(*) AS cnt, row_number() OVER (ORDER BY count(*) DESC) AS place
        FROM listing WHERE {c} IS NOT NULL GROUP BY {c}))""")
    u = " UNION ALL ".join(parts)
    ratio = "CASE WHEN n_unique <= 1 THEN 0.0E0 ELSE m1 * 1.0E0 / m2 END"
    pct = "n_unique * 100.0E0 / (SELECT count(*) FROM listing)"
    return (f"SELECT col_name, round({ratio}, 6) AS freq_ratio, round({pct}, 6) AS percent_unique, "
            f"(({ratio}) > {freq_cut} AND ({pct}) <= 10.0) OR n_unique <= 1 AS nzv FROM ({u}) t")


@register("near_zero_variance", _nzv_sql(NZV_COLS, 3.5))
def q_near_zero_variance(spark, sf):
    return encode.near_zero_variance(L(spark, sf).select(*NZV_COLS), freq_cut=3.5).withColumnRenamed(
        "column", "col_name")


# ---------------------------------------------------------------------------
# Scaling (E5-E7) and power transforms
# ---------------------------------------------------------------------------
SCALE_COLS = ["screen_size", "weight", "ram", "max_price"]


def _affine_sql(shift, scale_):
    return ", ".join(f"round(+0.0E0 + round((CAST({c} AS DOUBLE) - ({shift(c)})) / ({scale_(c)}), 6), 6) AS {c}"
                     for c in SCALE_COLS)


@register("min_max_scale", "SELECT id, " + _affine_sql(
    lambda c: f"(SELECT min({c}) FROM train)",
    lambda c: f"(SELECT CASE WHEN max({c}) > min({c}) THEN max({c}) - min({c}) ELSE 1 END FROM train)")
    + " FROM listing", ctes=TRAIN)
def q_min_max_scale(spark, sf):
    df = L(spark, sf)
    m = scale.fit_min_max(_train(df), SCALE_COLS)
    return m.transform(df.select("id", *SCALE_COLS)).select("id", *[z(c) for c in SCALE_COLS])


@register("min_max_inverse", "SELECT id, " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in SCALE_COLS)
          + " FROM listing")
def q_min_max_inverse(spark, sf):
    df = L(spark, sf)
    m = scale.fit_min_max(_train(df), SCALE_COLS)
    return m.inverse(m.transform(df.select("id", *SCALE_COLS))).select("id", *[r6(c) for c in SCALE_COLS])


@register("standardize", "SELECT id, " + _affine_sql(
    lambda c: f"(SELECT avg({c}) FROM train)", lambda c: f"(SELECT stddev_samp({c}) FROM train)")
    + " FROM listing", ctes=TRAIN)
def q_standardize(spark, sf):
    df = L(spark, sf)
    m = scale.fit_standardize(_train(df), SCALE_COLS)
    return m.transform(df.select("id", *SCALE_COLS)).select("id", *[z(c) for c in SCALE_COLS])


def _robust_sql(lo, hi):
    return "SELECT id, " + _affine_sql(
        lambda c: f"(SELECT quantile_cont({c}, 0.5) FROM train)",
        lambda c: (f"(SELECT CASE WHEN quantile_cont({c}, {hi}) - quantile_cont({c}, {lo}) = 0 THEN 1 "
                   f"ELSE quantile_cont({c}, {hi}) - quantile_cont({c}, {lo}) END FROM train)")) + " FROM listing"


@register("robust_scale_iqr", _robust_sql(0.25, 0.75), ctes=TRAIN)
def q_robust_scale_iqr(spark, sf):
    df = L(spark, sf)
    m = scale.fit_robust(_train(df), SCALE_COLS, (25.0, 75.0))
    return m.transform(df.select("id", *SCALE_COLS)).select("id", *[z(c) for c in SCALE_COLS])


@register("robust_scale_10_90", _robust_sql(0.1, 0.9), ctes=TRAIN)
def q_robust_scale_10_90(spark, sf):
    df = L(spark, sf)
    m = scale.fit_robust(_train(df), SCALE_COLS, (10.0, 90.0))
    return m.transform(df.select("id", *SCALE_COLS)).select("id", *[z(c) for c in SCALE_COLS])


YJ_X = "((max_price - 1500.0E0) / 100.0E0)"


@register("yeo_johnson", f"SELECT id, round({S.yj_sql(YJ_X, 0.5)}, 6) AS yj, "
                         f"round({S.yj_sql(YJ_X, 0.0)}, 6) AS yj0, round({S.yj_sql(YJ_X, 2.0)}, 6) AS yj2 FROM listing")
def q_yeo_johnson(spark, sf):
    df = L(spark, sf).select("id", ((F.col("max_price") - 1500.0) / 100.0).alias("x"))
    return df.select("id", C.r6(C.yeo_johnson("x", 0.5)).alias("yj"), C.r6(C.yeo_johnson("x", 0.0)).alias("yj0"),
                     C.r6(C.yeo_johnson("x", 2.0)).alias("yj2"))


def _fit_sql(expr_x, tf, jac):
    return f"""
, g AS (SELECT -2.0E0 + 4.0E0 * i / 40.0E0 AS lam FROM range(41) t(i)),
x AS (SELECT {expr_x} AS x FROM listing WHERE {expr_x} IS NOT NULL),
s AS (SELECT count(*) AS n, sum({jac}) AS j FROM x),
v AS (SELECT g.lam, var_pop({tf('x.x', 'g.lam')}) AS vp FROM g, x GROUP BY g.lam)
SELECT 'x' AS col_name, round(arg_max(v.lam, -s.n / 2.0E0 * ln(v.vp) + (v.lam - 1.0E0) * s.j), 6) AS lambda
FROM v, s"""


@register("yeo_johnson_fit", _fit_sql("max_price / 1000.0E0", S.yj_sql, "sign(x) * ln(1 + abs(x))"))
def q_yeo_johnson_fit(spark, sf):
    df = L(spark, sf).select((F.col("max_price") / 1000.0).alias("x"))
    llf = scale.power_llf(df, "x", [-2.0 + 4.0 * i / 40.0 for i in range(41)], "yeo-johnson")
    lam = max(llf, key=lambda t: t[1])[0]
    return spark.range(1).select(F.lit("x").alias("col_name"), F.round(F.lit(lam), 6).alias("lambda"))


@register("box_cox", f"SELECT id, round({S.bc_sql('(max_price / 1000.0E0)', 0.25)}, 6) AS bc FROM listing")
def q_box_cox(spark, sf):
    df = L(spark, sf).select("id", (F.col("max_price") / 1000.0).alias("x"))
    return df.select("id", C.r6(C.box_cox("x", 0.25)).alias("bc"))


@register("box_cox_fit", _fit_sql("max_price / 1000.0E0", S.bc_sql, "ln(x)"))
def q_box_cox_fit(spark, sf):
    df = L(spark, sf).select((F.col("max_price") / 1000.0).alias("x"))
    llf = scale.power_llf(df, "x", [-2.0 + 4.0 * i / 40.0 for i in range(41)], "box-cox")
    lam = max(llf, key=lambda t: t[1])[0]
    return spark.range(1).select(F.lit("x").alias("col_name"), F.round(F.lit(lam), 6).alias("lambda"))


_QN_P = "least(greatest(p, 1e-7), 1.0E0 - 1e-7)"


@register("quantile_normal", f"""
, r AS (SELECT id, weight, rank() OVER (ORDER BY weight) - 1 AS a, count(*) OVER (PARTITION BY weight) AS ne,
        count(*) OVER () AS n FROM listing WHERE weight IS NOT NULL),
p AS (SELECT id, (a + (a + ne - 1)) / 2.0E0 / (n - 1) AS p FROM r)
SELECT l.id, round({C.inverse_normal_sql(_QN_P)}, 6) AS weight
FROM listing l LEFT JOIN p ON l.id = p.id""")
def q_quantile_normal(spark, sf):
    df = L(spark, sf).select("id", "weight")
    n = df.filter(F.col("weight").isNotNull()).count()
    vr = value_ranks(df, "weight")
    p = ((F.col("n_lt") + (F.col("n_lt") + F.col("n_eq") - 1)) / 2.0 / F.lit(float(n - 1))).alias("p")
    joined = df.join(vr.select("weight", p), "weight", "left")
    return joined.select("id", F.round(F.expr(C.inverse_normal_sql(_QN_P)), 6).alias("weight"))


# ---------------------------------------------------------------------------
# Sampling (P1-P10)
# ---------------------------------------------------------------------------
def _rank_sql(seed, src="listing"):
    return f"row_number() OVER (ORDER BY {S.hash_sql('id', seed)}, id)"


@register("split_exact", f"SELECT id, CASE WHEN {_rank_sql(0)} <= round(0.75 * (SELECT count(*) FROM listing)) "
                         "THEN 'train' ELSE 'test' END AS split FROM listing")
def q_split_exact(spark, sf):
    return sample.split_exact(L(spark, sf).select("id"), 0.75, "id", 0)


@register("split_hash", "SELECT id, split FROM (SELECT id, CASE WHEN substring(" + S.hash_sql("id", 0)
          + f", 1, 8) < '{sample.hex_threshold(0.75)}' THEN 'train' ELSE 'test' END AS split FROM listing)")
def q_split_hash(spark, sf):
    return sample.split_hash(L(spark, sf).select("id"), 0.75, "id", 0)


@register("split_three_way", f"""
, r AS (SELECT id, {_rank_sql(42)} AS rk FROM listing),
c AS (SELECT count(*) AS n, CAST(ceil(0.25 * count(*)) AS BIGINT) AS t FROM listing)
SELECT id, CASE WHEN rk <= t THEN 'test' WHEN rk <= t + ceil(0.3 * (n - t)) THEN 'val' ELSE 'train' END AS split
FROM r, c""")
def q_split_three_way(spark, sf):
    return sample.split_three_way(L(spark, sf).select("id"), 0.25, 0.3, "id", 42)


SEEDS = (37, 38, 39, 40, 41)


@register("repeated_splits", " UNION ALL ".join(
    f"SELECT CAST({s} AS INTEGER) AS seed, id, CASE WHEN {_rank_sql(s)} <= ceil(0.2 * (SELECT count(*) FROM listing)) "
    f"THEN 'test' ELSE 'train' END AS split FROM listing" for s in SEEDS))
def q_repeated_splits(spark, sf):
    return sample.repeated_splits(L(spark, sf).select("id"), SEEDS, 0.2)


@register("kfold_contiguous", "SELECT id, CAST(ntile(5) OVER (ORDER BY id) - 1 AS INTEGER) AS fold FROM listing")
def q_kfold_contiguous(spark, sf):
    return sample.with_folds(L(spark, sf).select("id"), 5, "id", shuffle=False)


@register("kfold_shuffled", f"SELECT id, CAST(ntile(5) OVER (ORDER BY {S.hash_sql('id', 1)}, id) - 1 AS INTEGER) "
                            "AS fold FROM listing")
def q_kfold_shuffled(spark, sf):
    return sample.with_folds(L(spark, sf).select("id"), 5, "id", shuffle=True, seed=1)


@register("sample_weights", "SELECT id, round(max_price / (SELECT sum(max_price) FROM listing), 12) AS weight, "
                            "round(1.0E0 / (SELECT count(*) FROM listing), 12) AS weight0 FROM listing")
def q_sample_weights(spark, sf):
    df = L(spark, sf).select("id", "max_price")
    w = sample.with_weights(df, "max_price", order=1)
    w0 = sample.with_weights(w, "max_price", order=0, out="weight0")
    return w0.select("id", F.round("weight", 12).alias("weight"), F.round("weight0", 12).alias("weight0"))


_EXTRA = ("(CASE WHEN max_price > 2000 THEN 10 ELSE 0 END + CASE WHEN max_price >= 2200 AND max_price <= 2400 "
          "THEN 10 ELSE 0 END + CASE WHEN max_price >= 2600 AND max_price <= 3000 THEN 10 ELSE 0 END + "
          "CASE WHEN max_price >= 1200 AND max_price <= 2000 THEN 1 ELSE 0 END + CASE WHEN max_price >= 1000 "
          "AND max_price <= 1200 THEN 2 ELSE 0 END)")


@register("oversample_bands", f"SELECT id, CAST(unnest(generate_series(0, {_EXTRA})) AS INTEGER) AS copy FROM listing")
def q_oversample_bands(spark, sf):
    return sample.oversample(L(spark, sf).select("id", "max_price")).select("id", "copy")


LC_FRACS = (0.1, 0.325, 0.55, 0.775, 1.0)


@register("learning_curve_sizes", f"""
, r AS (SELECT id, {_rank_sql(7)} AS rk, count(*) OVER () AS n FROM listing)
SELECT id, CASE {' '.join(f'WHEN rk <= CAST(floor({f} * n) AS BIGINT) THEN {i}' for i, f in enumerate(LC_FRACS))} END
  AS subset FROM r""")
def q_learning_curve_sizes(spark, sf):
    return sample.learning_curve_sizes(L(spark, sf).select("id"), LC_FRACS, "id", 7)


# ---------------------------------------------------------------------------
# Joins and set operations
# ---------------------------------------------------------------------------
@register("bind_by_id", f"""SELECT l.id, l.screen_size, {S.hd_sql('l.pixels_x', 'l.pixels_y')} AS hd_resolution_category,
  l.min_price, l.max_price, round(p.pmn, 6) AS MIN, round(p.pmx, 6) AS MAX FROM listing l JOIN preds p ON l.id = p.id""")
def q_bind_by_id(spark, sf):
    df = L(spark, sf)
    feats = df.select("id", "screen_size")
    enc = df.select("id", C.hd_category().alias("hd_resolution_category"))
    tgt = df.select("id", "min_price", "max_price")
    pr = fx.preds(spark, sf).select("id", C.r6("pmn").alias("MIN"), C.r6("pmx").alias("MAX"))
    return relate.bind_by_id(feats, enc, tgt, pr)


@register("inner_join_labels", "SELECT l.id, l.brand, round(p.pmn, 6) AS MIN FROM listing l "
                               "JOIN preds p ON l.id = p.id WHERE p.pmn > p.pmx")
def q_inner_join_labels(spark, sf):
    pr = fx.preds(spark, sf).filter(F.col("pmn") > F.col("pmx")).select("id", C.r6("pmn").alias("MIN"))
    return relate.inner_join(L(spark, sf).select("id", "brand"), pr)


@register("join_best_params", """
, s AS (SELECT config_id, avg(value) AS m FROM cv_results GROUP BY config_id),
b AS (SELECT arg_min(config_id, m) AS config_id FROM s)
SELECT c.config_id, c.fold, c.value FROM cv_results c JOIN b ON c.config_id = b.config_id""")
def q_join_best_params(spark, sf):
    cv = fx.cv_results(spark, sf)
    best = relate.select_best(relate.summarize_configs(cv)).select("config_id")
    return cv.join(best, "config_id")


@register("semi_join_terms", "SELECT * FROM cv_results WHERE config_id IN (SELECT config_id FROM cv_results "
                             "WHERE value > (SELECT avg(value) + 500 FROM cv_results))")
def q_semi_join_terms(spark, sf):
    cv = fx.cv_results(spark, sf)
    thr = cv.agg(F.avg("value")).first()[0] + 500
    return relate.semi_join(cv, cv.filter(F.col("value") > thr).select("config_id"), "config_id")


@register("anti_join_split", f"""
, tr AS (SELECT id FROM (SELECT id, {_rank_sql(0)} AS rk FROM listing) WHERE rk <= round(0.75 * (SELECT count(*) FROM listing)))
SELECT l.id, l.max_price FROM listing l WHERE l.id NOT IN (SELECT id FROM tr)""")
def q_anti_join_split(spark, sf):
    df = L(spark, sf).select("id", "max_price")
    tr = sample.split_exact(df.select("id"), 0.75).filter(F.col("split") == "train").select("id")
    return relate.anti_join(df, tr, "id")


_BAND_SQL = [("gt2000", "max_price > 2000"), ("b2200_2400", "max_price >= 2200 AND max_price <= 2400"),
             ("b2600_3000", "max_price >= 2600 AND max_price <= 3000"),
             ("b1200_2000", "max_price >= 1200 AND max_price <= 2000"),
             ("b1000_1200", "max_price >= 1000 AND max_price <= 1200")]


@register("union_all_bands", " UNION ALL ".join(f"SELECT id, '{b}' AS band FROM listing WHERE {w}" for b, w in _BAND_SQL))
def q_union_all_bands(spark, sf):
    # the view once: bands that each join it anew would share its partitions, and a task would read all five of a partition
    df = cut_lineage(L(spark, sf).select("id", "max_price"))
    return relate.union_all(*[df.filter(w).select("id", F.lit(b).alias("band")) for b, w in _BAND_SQL])


# ---------------------------------------------------------------------------
# Ordering, ranking, top-k
# ---------------------------------------------------------------------------
_CV_SUM = "SELECT config_id, avg(value) AS mean_value FROM cv_results GROUP BY config_id"


@register("top_configs", f"SELECT config_id, round(mean_value, 6) AS mean_value FROM ({_CV_SUM}) "
                         "ORDER BY mean_value ASC, config_id LIMIT 5")
def q_top_configs(spark, sf):
    s = relate.summarize_configs(fx.cv_results(spark, sf))
    return relate.top_k(s, [F.asc("mean_value"), F.asc("config_id")], 5).select("config_id", r6("mean_value"))


@register("select_best", f"SELECT arg_min(config_id, mean_value) AS config_id, round(min(mean_value), 6) AS mean_value "
                         f"FROM ({_CV_SUM})")
def q_select_best(spark, sf):
    s = relate.summarize_configs(fx.cv_results(spark, sf))
    return relate.select_best(s).select("config_id", r6("mean_value"))


@register("nearest_lambda", f"""SELECT arg_min(config_id, abs(mean_value - (SELECT avg(value) FROM cv_results)))
  AS config_id, round(arg_min(mean_value, abs(mean_value - (SELECT avg(value) FROM cv_results))), 6) AS mean_value
  FROM ({_CV_SUM})""")
def q_nearest_lambda(spark, sf):
    cv = fx.cv_results(spark, sf)
    target = cv.agg(F.avg("value")).first()[0]
    return relate.nearest(relate.summarize_configs(cv), target).select("config_id", r6("mean_value"))


CORR_COLS = ["screen_size", "pixels_x", "pixels_y", "touchscreen", "detachable_keyboard", "discrete_gpu", "ram",
             "ssd", "storage", "weight", "min_price"]


@register("top_features", " UNION ALL ".join(
    f"SELECT '{c}' AS var_a, round(abs(corr({c}, max_price)), 6) AS abs_corr FROM listing" for c in CORR_COLS)
    .join(["SELECT * FROM (", ") ORDER BY abs_corr DESC LIMIT 8"]))
def q_top_features(spark, sf):
    cm = profile.corr_matrix(L(spark, sf), CORR_COLS + ["max_price"])
    t = cm.filter((F.col("var_b") == "max_price") & (F.col("var_a") != "max_price")).select(
        "var_a", F.round(F.abs("corr"), 6).alias("abs_corr"))
    return relate.top_k(t, [F.desc("abs_corr")], 8)


@register("row_ordinal", "SELECT id, row_number() OVER (ORDER BY id) AS ordinal FROM listing")
def q_row_ordinal(spark, sf):
    return relate.row_ordinal(L(spark, sf).select("id"), "id")


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------
@register("value_counts", "SELECT brand, count(*) AS n FROM listing GROUP BY brand")
def q_value_counts(spark, sf):
    return profile.value_counts(L(spark, sf), "brand")


@register("group_count_2", "SELECT os, touchscreen, count(*) AS n FROM listing GROUP BY os, touchscreen")
def q_group_count_2(spark, sf):
    return profile.group_count(L(spark, sf), "os", "touchscreen")


DESC_COLS = ["screen_size", "weight", "ram", "min_price", "max_price"]


@register("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM listing" for c in DESC_COLS))
def q_describe_numeric(spark, sf):
    d = profile.describe_numeric(L(spark, sf), DESC_COLS).withColumnRenamed("column", "col_name")
    return d.select("col_name", "count", *[r6(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


CAT_COLS = ["brand", "cpu", "os", "gpu", "screen_surface"]


def _top_sql(c):
    return (f"(SELECT {c} AS top, cnt AS freq FROM (SELECT {c}, count(*) AS cnt FROM listing WHERE {c} IS NOT NULL "
            f"GROUP BY {c}) ORDER BY cnt DESC, {c} LIMIT 1)")


@register("describe_categorical", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, (SELECT count({c}) FROM listing) AS count, "
    f"(SELECT count(DISTINCT {c}) FROM listing) AS \"unique\", t.top, t.freq FROM {_top_sql(c)} t" for c in CAT_COLS))
def q_describe_categorical(spark, sf):
    return profile.describe_categorical(L(spark, sf), CAT_COLS).withColumnRenamed("column", "col_name")


_DT = ("CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
       "WHEN 'DOUBLE' THEN 'double' ELSE any_value(typeof({c})) END")


@register("frame_info", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, {_DT.format(c=c)} AS dtype, count({c}) AS non_null, count(*) AS n_rows FROM listing"
    for c in LISTING))
def q_frame_info(spark, sf):
    return profile.frame_info(L(spark, sf)).withColumnRenamed("column", "col_name")


CM_COLS = ["screen_size", "pixels_x", "ram", "weight", "min_price", "max_price"]


def _corr_sql(cols):
    parts = []
    for a in cols:
        for b in cols:
            e = "max(1.0E0)" if a == b else f"corr({a}, {b})"
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, round({e}, 6) AS corr FROM listing")
    return " UNION ALL ".join(parts)


@register("corr_matrix", _corr_sql(CM_COLS))
def q_corr_matrix(spark, sf):
    return profile.corr_matrix(L(spark, sf), CM_COLS).select("var_a", "var_b", r6("corr"))


@register("corr_select", f"SELECT * FROM ({_corr_sql(CM_COLS)}) WHERE var_b IN ('min_price', 'max_price') "
                         "AND var_a NOT IN ('min_price', 'max_price') AND abs(corr) > 0.5")
def q_corr_select(spark, sf):
    return profile.corr_select(L(spark, sf), ["min_price", "max_price"], 0.5, CM_COLS).select(
        "var_a", "var_b", r6("corr"))


def _hist_sql(col, bins, extra=""):
    return f"""
, mm AS (SELECT min({col}) AS lo, max({col}) AS hi FROM listing),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1.0E0 END AS w FROM mm),
c AS (SELECT CAST(least(floor(({col} - w.lo) / w.w), {bins} - 1) AS INTEGER) AS bin, count(*) AS n
      FROM listing, w WHERE {col} IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range({bins}) t(i))
SELECT g.bin, round(w.lo + g.bin * w.w, 6) AS lower, round(w.lo + (g.bin + 1) * w.w, 6) AS upper,
  coalesce(c.n, 0) AS n{extra} FROM g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin"""


@register("histogram_fixed", _hist_sql("max_price", 30))
def q_histogram_fixed(spark, sf):
    h = profile.fixed_bins(L(spark, sf), "max_price", 30)
    return h.select("bin", r6("lower"), r6("upper"), "n")


def _auto_bins_sql(col):
    return f"""(SELECT CAST(ceil((max({col}) - min({col})) / least(
      CASE WHEN 2.0E0 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) * pow(count({col}), -1.0E0/3) > 0
        THEN 2.0E0 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) * pow(count({col}), -1.0E0/3)
        ELSE 1e308 END,
      (max({col}) - min({col})) / (log2(count({col})) + 1.0E0))) AS INTEGER) FROM listing)"""


@register("histogram_auto", f"""
, nb AS (SELECT {_auto_bins_sql('max_price')} AS bins),
mm AS (SELECT min(max_price) AS lo, max(max_price) AS hi FROM listing),
w AS (SELECT lo, (hi - lo) / nb.bins AS w, nb.bins FROM mm, nb),
c AS (SELECT CAST(least(floor((max_price - w.lo) / w.w), w.bins - 1) AS INTEGER) AS bin, count(*) AS n
      FROM listing, w WHERE max_price IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM nb, range(nb.bins) t(i))
SELECT g.bin, round(w.lo + g.bin * w.w, 6) AS lower, round(w.lo + (g.bin + 1) * w.w, 6) AS upper,
  coalesce(c.n, 0) AS n FROM g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin""")
def q_histogram_auto(spark, sf):
    h = profile.histogram_auto(L(spark, sf), "max_price")
    return h.select("bin", r6("lower"), r6("upper"), "n")


@register("hist_density", _hist_sql("max_price", 30, extra=", round(coalesce(c.n, 0) / ((SELECT count(max_price) "
                                                             "FROM listing) * w.w), 9) AS density"))
def q_hist_density(spark, sf):
    h = profile.hist_density(L(spark, sf), "max_price", 30)
    return h.select("bin", r6("lower"), r6("upper"), "n", F.round("density", 9).alias("density"))


@register("kde_binned", """
, mm AS (SELECT min(max_price) AS lo, max(max_price) AS hi FROM listing),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0E0 END AS w FROM mm),
c AS (SELECT CAST(least(floor((max_price - w.lo) / w.w), 29) AS INTEGER) AS bin, count(*) AS n
      FROM listing, w WHERE max_price IS NOT NULL GROUP BY 1),
hb AS (SELECT w.lo + c.bin * w.w AS lower, w.lo + (c.bin + 1) * w.w AS upper, c.n FROM c, w),
bw AS (SELECT 0.9E0 * least(stddev_samp(max_price), (quantile_cont(max_price, 0.75) - quantile_cont(max_price, 0.25))
       / 1.34E0) * pow(count(max_price), -0.2E0) AS h, count(max_price) AS n FROM listing),
rng AS (SELECT w.lo AS lo, w.lo + 30 * w.w AS hi FROM w),
gr AS (SELECT CAST(i AS INTEGER) AS g, rng.lo + i * ((rng.hi - rng.lo) / 63.0E0) AS x FROM rng, range(64) t(i))
SELECT gr.g, round(gr.x, 6) AS x, round(sum(hb.n * exp(-0.5E0 * pow((gr.x - (hb.lower + hb.upper) / 2.0E0) / bw.h, 2))
  / sqrt(2 * pi())) / (bw.n * bw.h), 9) AS density FROM gr, hb, bw GROUP BY gr.g, gr.x, bw.n, bw.h""")
def q_kde_binned(spark, sf):
    k = profile.kde_binned(L(spark, sf), "max_price", 30, 64)
    return k.select("g", r6("x"), F.round("density", 9).alias("density"))


@register("boxplot_stats", """
, q AS (SELECT quantile_cont(max_price, 0.25) AS q1, quantile_cont(max_price, 0.5) AS med,
        quantile_cont(max_price, 0.75) AS q3 FROM listing)
SELECT round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(min(max_price) FILTER (WHERE max_price >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(max_price) FILTER (WHERE max_price <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (WHERE max_price < q1 - 1.5 * (q3 - q1) OR max_price > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM listing, q GROUP BY q1, med, q3""")
def q_boxplot_stats(spark, sf):
    b = profile.boxplot_stats(L(spark, sf), "max_price")
    return b.select(*[r6(c) for c in ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]], "n_outliers")


LV_PROBS = profile.letter_value_probs(4)


@register("letter_values", " UNION ALL ".join(
    f"SELECT cpu, count(max_price) AS n, CAST({p!r} AS DOUBLE) AS prob, round(quantile_cont(max_price, {p!r}), 6) "
    "AS value FROM listing GROUP BY cpu" for p in LV_PROBS))
def q_letter_values(spark, sf):
    return profile.letter_values(L(spark, sf), "max_price", ["cpu"], 4).select("cpu", "n", "prob", r6("value"))


@register("grouped_distribution", """SELECT cpu, discrete_gpu, count(max_price) AS n,
  round(quantile_cont(max_price, 0.25), 6) AS q25, round(quantile_cont(max_price, 0.5), 6) AS q50,
  round(quantile_cont(max_price, 0.75), 6) AS q75, min(max_price) AS min, max(max_price) AS max
  FROM listing GROUP BY cpu, discrete_gpu""")
def q_grouped_distribution(spark, sf):
    g = profile.grouped_distribution(L(spark, sf), "max_price", "cpu", "discrete_gpu")
    return g.select("cpu", "discrete_gpu", "n", r6("q25"), r6("q50"), r6("q75"), "min", "max")


PAIR_COLS = ["screen_size", "weight", "ram", "max_price"]


def _pair_sql(cols, bins=10):
    idx = {c: (f"CAST(least(floor((CAST({c} AS DOUBLE) - (SELECT min({c}) FROM listing)) / (SELECT CASE WHEN max({c}) > "
               f"min({c}) THEN (max({c}) - min({c})) / {bins}.0E0 ELSE 1.0E0 END FROM listing)), {bins - 1}) AS INTEGER)")
           for c in cols}
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {idx[a]} AS bin_a, {idx[b]} AS bin_b FROM listing "
                         f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return f"SELECT var_a, var_b, bin_a, bin_b, count(*) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"


@register("pair_bins", _pair_sql(PAIR_COLS))
def q_pair_bins(spark, sf):
    return profile.pair_bins(L(spark, sf), PAIR_COLS, 10)


_FILL = ("CASE WHEN i = 1 THEN 1.0E0 - pow(0.5E0, 1.0E0 / n) WHEN i = n THEN pow(0.5E0, 1.0E0 / n) "
         "ELSE (i - 0.3175E0) / (n + 0.365E0) END")


@register("qq_points", f"""
, r AS (SELECT row_number() OVER (ORDER BY max_price) AS i, max_price AS sample, count(*) OVER () AS n
        FROM listing WHERE max_price IS NOT NULL),
m AS (SELECT i, sample, {_FILL} AS m FROM r)
SELECT i, round({C.inverse_normal_sql('m')}, 6) AS theoretical, sample FROM m""")
def q_qq_points(spark, sf):
    q = profile.qq_points(L(spark, sf), "max_price")
    return q.select("i", r6("theoretical"), "sample")


@register("unique_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) = count(*) AS is_unique "
    f"FROM listing" for c in LISTING))
def q_unique_columns(spark, sf):
    return profile.unique_columns(L(spark, sf)).withColumnRenamed("column", "col_name")


PROF_COLS = ["screen_size", "weight", "ram", "ssd", "max_price"]


def _prof_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS col_name, count(*) AS n, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS "distinct",
  count(*) FILTER (WHERE {c} = 0) AS zeros, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std,
  round(stddev_samp({x}) / avg({x}), 6) AS cv,
  round(avg(pow({x} - (SELECT avg({c}) FROM listing), 3)) / pow(var_pop({x}), 1.5), 6) AS skewness,
  round(avg(pow({x} - (SELECT avg({c}) FROM listing), 4)) / pow(var_pop({x}), 2) - 3, 6) AS kurtosis,
  round(min({x}), 6) AS min, round(max({x}), 6) AS max, round(quantile_cont({x}, 0.05), 6) AS q05,
  round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50,
  round(quantile_cont({x}, 0.75), 6) AS q75, round(quantile_cont({x}, 0.95), 6) AS q95,
  round((SELECT quantile_cont(abs({x} - (SELECT quantile_cont({c}, 0.5) FROM listing)), 0.5) FROM listing), 6) AS mad
  FROM listing"""


PROF_OUT = ["mean", "std", "cv", "skewness", "kurtosis", "min", "max", "q05", "q25", "q50", "q75", "q95", "mad"]


@register("profile_numeric", " UNION ALL ".join(_prof_sql(c) for c in PROF_COLS))
def q_profile_numeric(spark, sf):
    p = profile.profile_numeric(L(spark, sf), PROF_COLS).withColumnRenamed("column", "col_name")
    return p.select("col_name", "n", "missing", "distinct", "zeros", *[r6(c) for c in PROF_OUT])


@register("profile_categorical", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, (SELECT count(*) FROM listing) AS n, (SELECT count(*) - count({c}) FROM listing) "
    f"AS missing, (SELECT count(DISTINCT {c}) FROM listing) AS \"distinct\", t.top, t.freq FROM {_top_sql(c)} t"
    for c in CAT_COLS))
def q_profile_categorical(spark, sf):
    return profile.profile_categorical(L(spark, sf), CAT_COLS).withColumnRenamed("column", "col_name")


def _alerts_sql():
    num = " UNION ALL ".join(f"""SELECT col_name, unnest([
  CASE WHEN "distinct" <= 1 THEN 'constant' END, CASE WHEN missing * 100.0E0 / n > 5 THEN 'missing' END,
  CASE WHEN abs(skewness) > 1 THEN 'skewed' END, CASE WHEN zeros * 100.0E0 / n > 10 THEN 'zeros' END]) AS alert
  FROM ({_prof_sql(c)})""" for c in PROF_COLS)
    cat = " UNION ALL ".join(f"""SELECT '{c}' AS col_name, unnest([
  CASE WHEN count(DISTINCT {c}) <= 1 THEN 'constant' END,
  CASE WHEN (count(*) - count({c})) * 100.0E0 / count(*) > 5 THEN 'missing' END,
  CASE WHEN count(DISTINCT {c}) * 1.0E0 / count({c}) > 0.5 THEN 'high_cardinality' END]) AS alert FROM listing"""
                     for c in CAT_COLS)
    corr = (f"SELECT DISTINCT var_a AS col_name, 'high_correlation' AS alert FROM ({_corr_sql(PROF_COLS)}) "
            "WHERE var_a <> var_b AND abs(corr) > 0.9")
    return f"SELECT * FROM ({num} UNION ALL {cat} UNION ALL {corr}) WHERE alert IS NOT NULL"


@register("profile_alerts", _alerts_sql())
def q_profile_alerts(spark, sf):
    return profile.profile_alerts(L(spark, sf), PROF_COLS, CAT_COLS).withColumnRenamed("column", "col_name")


@register("prep_sanity", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, round(avg(s), 6) + 0.0E0 AS mean, round(stddev_samp(s), 6) AS sd FROM "
    f"(SELECT (CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM train)) / (SELECT stddev_samp({c}) FROM train) AS s "
    f"FROM train)" for c in SCALE_COLS), ctes=TRAIN)
def q_prep_sanity(spark, sf):
    tr = _train(L(spark, sf))
    m = scale.fit_standardize(tr, SCALE_COLS)
    p = profile.prep_sanity(m.transform(tr), SCALE_COLS).withColumnRenamed("column", "col_name")
    return p.select("col_name", (F.round("mean", 6) + F.lit(0.0)).alias("mean"), r6("sd"))


# ---------------------------------------------------------------------------
# Tuning tables: aggregation side (T4, T7, T8) and distribution comparison
# ---------------------------------------------------------------------------
@register("cv_curve_summary", "SELECT config_id, round(avg(value), 6) AS mean_value, round(stddev_pop(value), 6) "
                              "AS sd_value, count(*) AS n_folds FROM cv_results GROUP BY config_id")
def q_cv_curve_summary(spark, sf):
    s = relate.summarize_configs(fx.cv_results(spark, sf))
    return s.select("config_id", r6("mean_value"), r6("sd_value"), "n_folds")


@register("model_comparison", "SELECT config_id AS model, " + ", ".join(
    f"round(avg(value) FILTER (WHERE fold = {i}), 6) AS s{i}" for i in range(5))
    + ", round(avg(value), 6) AS row_mean FROM cv_results GROUP BY config_id")
def q_model_comparison(spark, sf):
    cv = fx.cv_results(spark, sf)
    p = cv.groupBy(F.col("config_id").alias("model")).pivot("fold", list(range(5))).agg(F.avg("value"))
    means = cv.groupBy(F.col("config_id").alias("model")).agg(F.avg("value").alias("row_mean"))
    return p.join(means, "model").select("model", *[C.r6(F.col(f"`{i}`")).alias(f"s{i}") for i in range(5)],
                                         r6("row_mean"))


def _lc_sql():
    sizes = " ".join(f"WHEN rk <= CAST(floor({f} * n) AS BIGINT) THEN {i}" for i, f in enumerate(LC_FRACS))
    return f"""
, r AS (SELECT id, max_price, {_rank_sql(7)} AS rk, count(*) OVER () AS n,
        CAST(ntile(5) OVER (ORDER BY {S.hash_sql('id', 3)}, id) - 1 AS INTEGER) AS fold FROM listing),
s AS (SELECT id, max_price, fold, CASE {sizes} END AS subset FROM r),
combos AS (SELECT CAST(i AS INTEGER) AS size_id, CAST(f AS INTEGER) AS fold FROM range(5) a(i), range(5) b(f)),
fit AS (SELECT c.size_id, c.fold, avg(s.max_price) AS pred, count(*) AS n_train FROM combos c JOIN s
        ON s.subset <= c.size_id AND s.fold <> c.fold GROUP BY c.size_id, c.fold),
sc AS (SELECT fit.size_id, fit.fold, avg(abs(s.max_price - fit.pred)) AS test_mae FROM fit JOIN s ON s.fold = fit.fold
       GROUP BY fit.size_id, fit.fold)
SELECT sc.size_id, round(avg(test_mae), 6) AS mean_test_mae, round(stddev_pop(test_mae), 6) AS sd_test_mae
FROM sc GROUP BY sc.size_id"""


@register("learning_curve_summary", _lc_sql())
def q_learning_curve_summary(spark, sf):
    """Learning curve of the mean predictor: nested training sizes × 5 folds, all
    scored in three grouped aggregates (the size×fold grid is a literal explode)."""
    df = L(spark, sf).select("id", "max_price")
    s = sample.learning_curve_sizes(df, LC_FRACS, "id", 7)
    s = sample.with_folds(s, 5, "id", shuffle=True, seed=3)
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("size_id"), F.lit(f).alias("tfold"))
                               for i in range(len(LC_FRACS)) for f in range(5)])).alias("g")
    train_rows = s.select("max_price", "subset", "fold", grid).select("max_price", "subset", "fold", "g.*").filter(
        (F.col("subset") <= F.col("size_id")) & (F.col("fold") != F.col("tfold")))
    fit = train_rows.groupBy("size_id", "tfold").agg(F.avg("max_price").alias("pred"))
    test = s.select("max_price", F.col("fold").alias("tfold"))
    sc = test.join(fit, "tfold").groupBy("size_id", "tfold").agg(
        F.avg(F.abs(F.col("max_price") - F.col("pred"))).alias("test_mae"))
    return sc.groupBy("size_id").agg(C.r6(F.avg("test_mae")).alias("mean_test_mae"),
                                     C.r6(F.stddev_pop("test_mae")).alias("sd_test_mae"))


@register("compare_distributions", """
, u AS (SELECT 'train' AS source, min_price AS v FROM listing UNION ALL SELECT 'test' AS source, pmn AS v FROM preds),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM u),
w AS (SELECT lo, (hi - lo) / 30 AS w FROM mm),
c AS (SELECT source, CAST(least(floor((v - w.lo) / w.w), 29) AS INTEGER) AS bin, count(*) AS n FROM u, w GROUP BY 1, 2),
g AS (SELECT s.source, CAST(i AS INTEGER) AS bin FROM (SELECT DISTINCT source FROM u) s, range(30) t(i))
SELECT g.source, g.bin, round(w.lo + g.bin * w.w, 6) AS lower, round(w.lo + (g.bin + 1) * w.w, 6) AS upper,
  coalesce(c.n, 0) AS n FROM g CROSS JOIN w LEFT JOIN c ON g.source = c.source AND g.bin = c.bin""")
def q_compare_distributions(spark, sf):
    tr = L(spark, sf).select(F.col("min_price").alias("MIN"))
    te = fx.preds(spark, sf).select(F.col("pmn").alias("MIN"))
    h = evaluate.compare_distributions({"train": tr, "test": te}, "MIN", bins=30)
    return h.select("source", "bin", r6("lower"), r6("upper"), "n")
