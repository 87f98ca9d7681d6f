"""Tuning and model assessment.

Folds are a column (deterministic, see ``sample.with_folds``).  Inside each
fold the preprocessing is re-fitted on the fold's training part only (no
leakage), its output is persisted once and shared by all configurations; every
configuration is one distributed fit, and all configurations of a fold are
scored in a single aggregate over the held-out part.  Only one metric value per
(configuration, fold) reaches the driver.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import hash_ranked
from ..session import cut_lineage
from . import boosting as B
from . import models as M
from . import trees as G
from .impact import _spread
from .sample import with_folds

MEAN_METRIC = "mae"


def _space_sample(space: dict[str, Sequence], n_iter: int, seed: int) -> list[dict]:
    """Seeded sample of ``n_iter`` distinct parameter maps from a finite grid."""
    keys = sorted(space)
    total = math.prod(len(space[k]) for k in keys)
    rng = random.Random(seed)
    picks = rng.sample(range(total), min(n_iter, total))
    out = []
    for p in picks:
        cfg = {}
        for k in keys:
            vals = list(space[k])
            p, i = divmod(p, len(vals))
            cfg[k] = vals[i]
        out.append(cfg)
    return out


def grid(space: dict[str, Sequence]) -> list[dict]:
    """Exhaustive parameter grid."""
    return _space_sample(space, math.prod(len(v) for v in space.values()), 0) if space else [{}]


def _halton(i: int, base: int) -> float:
    f, r = 1.0, 0.0
    while i > 0:
        f /= base
        i, d = divmod(i, base)
        r += f * d
    return r


def halton_configs(ranges: dict[str, tuple], n: int = 20, skip: int = 1) -> list[dict]:
    """Space-filling design (T3, re-aimed max-entropy grid): Halton points mapped
    to each range; a range is (lo, hi, 'int' | 'float' | 'log')."""
    primes = [2, 3, 5, 7, 11, 13, 17, 19, 23, 29]
    keys = sorted(ranges)
    out = []
    for i in range(skip, skip + n):
        cfg = {}
        for d, k in enumerate(keys):
            lo, hi, kind = ranges[k]
            u = _halton(i, primes[d])
            if kind == "log":
                cfg[k] = float(math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))))
            elif kind == "int":
                cfg[k] = int(round(lo + u * (hi - lo)))
            else:
                cfg[k] = float(lo + u * (hi - lo))
        out.append(cfg)
    return out


def cross_validate(df: DataFrame, kind: str, configs: Sequence[dict], label: str = "max_price", k: int = 5,
                   key: str = "id", shuffle: bool = True, seed: int = 0, target: str = "none",
                   parallelism: int = 4, numeric: Sequence[str] = M.NUMERIC,
                   categorical: Sequence[str] = M.CATEGORICAL, folds: DataFrame | None = None,
                   with_train: bool = False) -> DataFrame:
    """Long metric table (config_id, fold, mae[, mae_train]) of every configuration
    under k-fold CV.  Configurations of one fold are fitted concurrently
    (driver threads submitting Spark jobs, like ``CrossValidator(parallelism)``)."""
    spark = df.sparkSession
    fd = folds if folds is not None else with_folds(df, k, key, shuffle=shuffle, seed=seed)
    fd = fd.persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for f in range(k):
        tr, va = fd.filter(F.col("fold") != f), fd.filter(F.col("fold") == f)
        tt = M.TargetTransform(target).fit(tr, [label])
        prep = Pipeline(stages=M.preprocessing(numeric, categorical)).fit(M.cast_numeric(tr, numeric))
        trf = prep.transform(M.cast_numeric(tr, numeric)).select(
            key, "features", F.col(label).cast("double").alias("__t"), tt.forward(label).alias("__y")
        ).persist(StorageLevel.MEMORY_AND_DISK)
        vaf = prep.transform(M.cast_numeric(va, numeric)).select(
            key, "features", F.col(label).cast("double").alias("__t")).persist(StorageLevel.MEMORY_AND_DISK)

        def fit(i_cfg):
            i, cfg = i_cfg
            return M.estimator(kind, "__y", prediction=f"__p{i}", **dict(cfg)).fit(trf)

        with ThreadPoolExecutor(max(1, parallelism)) as ex:
            fitted = list(ex.map(fit, enumerate(configs)))

        def score(frame):
            for m in fitted:
                frame = m.transform(frame)
            aggs = [F.avg(F.abs(F.col("__t") - tt.inverse(F.col(f"__p{i}"), label))).alias(f"m{i}")
                    for i in range(len(fitted))]
            return frame.agg(*aggs).first()

        v = score(vaf)
        t = score(trf) if with_train else None
        for i in range(len(fitted)):
            rows.append((i, f, float(v[f"m{i}"])) + ((float(t[f"m{i}"]),) if with_train else ()))
        trf.unpersist(blocking=True)
        vaf.unpersist(blocking=True)
    fd.unpersist(blocking=True)
    schema = "config_id int, fold int, mae double" + (", mae_train double" if with_train else "")
    return spark.createDataFrame(rows, schema)


def _fold_targets(tr_of, label: str, target: str, k: int):
    """One target transform for all folds, or one per fold where it has fitted parameters."""
    if target in ("none", "log"):
        return [M.TargetTransform(target)]
    return [M.TargetTransform(target).fit(tr_of(f), [label]) for f in range(k)]


def forest_cross_validate(df: DataFrame, configs: Sequence[dict], label: str = "max_price", k: int = 5, key: str = "id", shuffle: bool = True,
                          seed: int = 0, target: str = "none", numeric: Sequence[str] = M.NUMERIC, categorical: Sequence[str] = M.CATEGORICAL,
                          folds: DataFrame | None = None, with_train: bool = False, bootstrap: bool = True, bins: int = 64,
                          local_rows: int = G.LOCAL_ROWS) -> DataFrame:
    """``cross_validate`` for forests, every tree of every configuration and fold grown in one plan (``trees.grow``).

    A configuration may name numTrees, maxDepth, minInstancesPerNode and featureSubsetStrategy.  Configurations that
    differ only in the first two share their trees: a forest of t trees is the first t trees of the largest one, and a
    tree of depth d is the deepest one cut at d.  (config_id, fold, mae[, mae_train])."""
    spark = df.sparkSession
    fd = folds if folds is not None else with_folds(df, k, key, shuffle=shuffle, seed=seed)
    fd = fd.filter(F.col(label).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    tts = _fold_targets(lambda f: fd.filter(F.col("fold") != f), label, target, k)
    layout = G.fit_layout(fd, numeric, categorical, bins)
    rows = G.bin_rows(fd.withColumn("__t", F.col(label).cast("double")), layout, key, [tt.forward(label) for tt in tts] + ["__t"], F.array("fold"))
    fd.unpersist()
    d = len(layout.sizes)
    shared: dict[tuple, dict] = {}
    for i, c in enumerate(configs):
        fam = shared.setdefault((c.get("featureSubsetStrategy", "auto"), int(c.get("minInstancesPerNode", 1))), {"count": 0, "depth": 0, "of": []})
        fam["count"], fam["depth"] = max(fam["count"], int(c.get("numTrees", 1))), max(fam["depth"], int(c.get("maxDepth", 5)))
        fam["of"].append(i)
    parts = []
    scale = G.scales(rows, len(tts))
    for (strategy, least), fam in sorted(shared.items()):
        specs = [G.Spec(seed=(seed * k + f) * 1_000_003 + j, target=f % len(tts), op="ne", value=f, features=G.subset(strategy, d, bootstrap), min_rows=least,
                        max_depth=fam["depth"], bootstrap=bootstrap) for f in range(k) for j in range(fam["count"])]
        trees = G.grow_forests(rows, specs, layout, len(tts), local_rows, scale, stored=True)
        heads, names = [], []
        for i in fam["of"]:
            for f in range(k):
                n = int(configs[i].get("numTrees", 1))
                heads.append(G.Head(list(range(f * fam["count"], (f + 1) * fam["count"])), n, int(configs[i].get("maxDepth", 5)), specs[f * fam["count"]]))
                names.append((i, f))
        scored = G.predict(rows, trees, heads, layout, key, [f"y{len(tts)}"], "all" if with_train else "test")
        long = (scored.select(F.col(f"y{len(tts)}").alias("t"), F.posexplode(F.arrays_zip("learns", "preds")).alias("h", "z"))
                .filter("z.preds IS NOT NULL").select("t", "h", "z.learns", "z.preds"))
        back = tts[0].inverse(F.col("preds"), label)
        for f, tt in enumerate(tts[1:], 1):
            back = F.when(F.col("h") % k == f, tt.inverse(F.col("preds"), label)).otherwise(back)
        err = F.abs(F.col("t") - back)
        got = long.groupBy("h").agg(F.avg(F.when(~F.col("learns"), err)).alias("e"), F.avg(F.when(F.col("learns"), err)).alias("et")).collect()
        parts += [(*names[r["h"]], r["e"], *([r["et"]] if with_train else [])) for r in got]
    schema = "config_id int, fold int, mae double" + (", mae_train double" if with_train else "")
    return spark.createDataFrame(sorted(parts, key=lambda r: r[:2]), schema)


def boost_cross_validate(df: DataFrame, configs: Sequence[dict], label: str = "max_price", k: int = 5, key: str = "id", shuffle: bool = True, seed: int = 0,
                         numeric: Sequence[str] = M.NUMERIC, categorical: Sequence[str] = M.CATEGORICAL, folds: DataFrame | None = None, bins: int = 64,
                         local_rows: int = G.LOCAL_ROWS) -> DataFrame:
    """``cross_validate`` for boosting: a configuration names fields of ``boosting.Boost``; the models of all
    configurations and folds take their rounds together.  With ``patience`` a fold's held-out rows tell when to stop.
    (config_id, fold, mae, rounds)."""
    fd = folds if folds is not None else with_folds(df, k, key, shuffle=shuffle, seed=seed)
    fd = fd.filter(F.col(label).isNotNull())
    layout = G.fit_layout(fd, numeric, categorical, bins)
    rows = G.bin_rows(fd, layout, key, [label], F.array("fold"))
    names = [(i, f) for i in range(len(configs)) for f in range(k)]
    models = B.fit_boosting(rows, [B.Boost(**{"seed": seed + 1, **configs[i]}, op="ne", value=f) for i, f in names], layout, local_rows)
    long = (B.boost_predict(rows, models, layout, key, ["y0"]).select("y0", F.posexplode(F.arrays_zip("learns", "preds")).alias("h", "z"))
            .filter("NOT z.learns AND z.preds IS NOT NULL"))
    got = long.groupBy("h").agg(F.avg(F.abs(F.col("y0") - F.col("z.preds"))).alias("e")).collect()
    return df.sparkSession.createDataFrame(sorted((*names[r["h"]], r["e"], models[r["h"]].best) for r in got), "config_id int, fold int, mae double, rounds int")


def forest_learning_curve(df: DataFrame, params: dict, label: str = "max_price", sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0),
                          splits: int = 50, test: float = 0.2, key: str = "id", seed: int = 0, bootstrap: bool = False,
                          numeric: Sequence[str] = M.NUMERIC, categorical: Sequence[str] = M.CATEGORICAL, bins: int = 64,
                          local_rows: int = G.LOCAL_ROWS) -> DataFrame:
    """``learning_curve`` over ``splits`` shuffle splits with all fits in one plan: (size, fold, n_train, mae_train,
    mae_test, fit_s).  ``fit_s`` is the time in which a fit's trees were grown, its share of the shared passes included."""
    from ..functions.columns import hash_unit
    from .sample import repeated_splits

    base = df.filter(F.col(label).isNotNull())
    sp = repeated_splits(base, range(seed, seed + splits), test, key)
    held = sp.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seed", (F.col("split") == "test").alias("out")))), lambda z: z["out"]).alias("__out"))
    u = hash_unit(key, f"lc{seed}")
    step = F.lit(G.UNUSED)
    for j in reversed(range(len(sizes))):
        step = F.when((u < F.lit(float(sizes[j]))) if sizes[j] < 1.0 else F.lit(True), j).otherwise(step)
    fd = base.join(held, key).withColumn("__step", step)
    layout = G.fit_layout(base, numeric, categorical, bins)
    rows = G.bin_rows(fd, layout, key, [label], F.transform("__out", lambda o: F.when(o, 255).otherwise(F.col("__step"))))
    count = int(params.get("numTrees", 1))
    names = [(j, i) for i in range(splits) for j in range(len(sizes))]
    specs = [G.Spec(seed=(seed + i) * 1_000_003 + t, scheme=i, op="le", value=j, features=G.subset(params.get("featureSubsetStrategy", "auto"), len(layout.sizes), bootstrap),
                    min_rows=int(params.get("minInstancesPerNode", 1)), max_depth=int(params.get("maxDepth", 5)), bootstrap=bootstrap)
             for j, i in names for t in range(count)]
    trees = G.grow_forests(rows, specs, layout, local_rows=local_rows)
    heads = [G.Head(list(range(h * count, (h + 1) * count)), count, None, specs[h * count]) for h in range(len(names))]
    scored = G.predict(rows, trees, heads, layout, key, ["y0", "s"])
    long = (scored.select("y0", "s", F.posexplode(F.arrays_zip("learns", "preds")).alias("h", "z")).filter("z.preds IS NOT NULL").select("y0", "h", "s", "z.learns", "z.preds"))
    is_test = F.substring("s", (F.floor(F.col("h") / len(sizes)) + 1).cast("int"), F.lit(1)) == F.lit(b"\xff")
    err = F.abs(F.col("y0") - F.col("preds"))
    got = long.groupBy("h").agg(F.sum(F.col("learns").cast("long")).alias("n"), F.avg(F.when(F.col("learns"), err)).alias("a"), F.avg(F.when(is_test, err)).alias("b")).collect()
    rows_ = [(float(sizes[names[r["h"]][0]]), names[r["h"]][1], int(r["n"]), r["a"], r["b"], float(sum(trees[m].seconds for m in heads[r["h"]].members))) for r in got]
    return df.sparkSession.createDataFrame(sorted(rows_, key=lambda r: (r[1], r[0])), "size double, fold int, n_train long, mae_train double, mae_test double, fit_s double")


def summarize(results: DataFrame, value: str = "mae") -> DataFrame:
    """Fold mean and population sd per configuration (T4/T5)."""
    return results.groupBy("config_id").agg(F.avg(value).alias("mean_mae"), F.stddev_pop(value).alias("std_mae"),
                                            F.count(F.lit(1)).alias("n_folds"))


def configs_table(spark, configs: Sequence[dict]) -> DataFrame:
    rows = [(i, k, str(v)) for i, c in enumerate(configs) for k, v in sorted(c.items())]
    return spark.createDataFrame(rows, "config_id int, param string, value string")


def random_search(df: DataFrame, kind: str, space: dict[str, Sequence], n_iter: int = 10, k: int = 5,
                  seed: int = 1, **kw) -> tuple[DataFrame, list[dict]]:
    """Random search (T1): ``n_iter`` seeded configurations under k-fold CV."""
    configs = _space_sample(space, n_iter, seed)
    return cross_validate(df, kind, configs, k=k, seed=seed, **kw), configs


def best_config(results: DataFrame, configs: Sequence[dict]) -> dict:
    """``select_best``: smallest mean MAE, ties to the lowest config id (a
    one-row aggregate; configs are few)."""
    s = summarize(results)
    r = s.agg(F.min_by("config_id", F.struct("mean_mae", "config_id")).alias("c")).first()
    return dict(configs[int(r["c"])])


def oof_predictions(df: DataFrame, kind: str, params: dict, label: str = "max_price", k: int = 5,
                    key: str = "id", seed: int = 0, target: str = "none", folds: DataFrame | None = None,
                    name: str | None = None) -> DataFrame:
    """Held-out predictions of every row (T6): each row is predicted by the model
    of the one fold that did not see it.  Long form (id, fold, base, truth, pred)."""
    fd = folds
    if fd is None:  # stored once: every fold's fit and prediction would make the rows and their folds anew
        df = fd = cut_lineage(with_folds(df, k, key, shuffle=True, seed=seed))
    parts = []
    for f in range(k):
        tr, va = fd.filter(F.col("fold") != f), fd.filter(F.col("fold") == f)
        m = M.fit_interval_model(tr, kind, labels=[label], target=target, params=params)
        p = m.transform(va, key=key).select(F.col("ID").alias(key), F.lit(f).alias("fold"),
                                            F.col(M.OUT.get(label, f"pred_{label}")).alias("pred"))
        parts.append(p)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(df.select(key, F.col(label).cast("double").alias("truth")), key).withColumn(
        "base", F.lit(name or kind))


def learning_curve(df: DataFrame, kind: str, params: dict, label: str = "max_price",
                   sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), k: int = 5, key: str = "id",
                   seed: int = 0, splits: int | None = None, test: float = 0.2) -> DataFrame:
    """Learning curve (T7): for each fold and nested training fraction, train and
    test MAE and the fit wall time (size, fold, n_train, mae_train, mae_test, fit_s).
    With ``splits``, so many shuffle splits that hold out ``test`` (P5) in place of k folds."""
    from ..functions.columns import hash_unit
    from .sample import repeated_splits

    base = df.withColumn("__u", hash_unit(key, f"lc{seed}"))
    if splits is None:
        fd = with_folds(base, k, key, shuffle=True, seed=seed)
    else:
        sp = repeated_splits(df, range(seed, seed + splits), test, key).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for f in range(k if splits is None else splits):
        if splits is None:
            tr, va = fd.filter(F.col("fold") != f), fd.filter(F.col("fold") == f)
        else:
            one = base.join(sp.filter(F.col("seed") == seed + f).select(key, "split"), key)
            tr, va = (one.filter(F.col("split") == w).drop("split") for w in ("train", "test"))
        for s in sizes:
            sub = tr.filter(F.col("__u") < F.lit(float(s))) if s < 1.0 else tr
            t0 = time.time()
            m = M.fit_interval_model(sub, kind, labels=[label], params=params)
            fit_s = time.time() - t0
            o = M.OUT.get(label, f"pred_{label}")
            e_tr = m.transform(sub, keep=[label]).agg(F.count(F.lit(1)), F.avg(F.abs(F.col(label) - F.col(o)))).first()
            e_te = m.transform(va, keep=[label]).agg(F.avg(F.abs(F.col(label) - F.col(o)))).first()[0]
            rows.append((float(s), f, int(e_tr[0]), float(e_tr[1]), float(e_te), float(fit_s)))
    if splits is not None:
        sp.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "size double, fold int, n_train long, mae_train double, mae_test double, fit_s double")


def model_comparison(df: DataFrame, kinds: dict[str, dict], seeds: Sequence[int] = (37, 38, 39),
                     label: str = "max_price", test: float = 0.2, key: str = "id") -> DataFrame:
    """Test MAE of each model × seed (T8) — long form (model, seed, mae)."""
    from .sample import split_hash

    rows = []
    for s in seeds:
        sp = split_hash(df, 1.0 - test, key, s)
        tr, te = sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")
        for name, (kind, params) in kinds.items():
            m = M.fit_interval_model(tr, kind, labels=[label], params=params)
            o = M.OUT.get(label, f"pred_{label}")
            e = m.transform(te, keep=[label]).agg(F.avg(F.abs(F.col(label) - F.col(o)))).first()[0]
            rows.append((name, int(s), float(e)))
    return df.sparkSession.createDataFrame(rows, "model string, seed int, mae double")


# ---------------------------------------------------------------------------
# Stacking (M11)
# ---------------------------------------------------------------------------
class StackingModel:
    def __init__(self, bases: dict, meta, label: str, names: list[str]):
        self.bases, self.meta, self.label, self.names = bases, meta, label, names

    def transform(self, df: DataFrame, key: str = "id") -> DataFrame:
        o = M.OUT.get(self.label, f"pred_{self.label}")
        wide = df.select(key)
        for name in self.names:
            p = self.bases[name].transform(df, key=key).select(F.col("ID").alias(key), F.col(o).alias(name))
            wide = wide.join(p, key)
        feats = VectorAssembler(inputCols=self.names, outputCol="__z").transform(wide)
        return self.meta.transform(feats).select(key, F.col("prediction").alias(o))


def fit_stacking(df: DataFrame, bases: dict[str, tuple[str, dict]], label: str = "max_price", k: int = 5,
                 key: str = "id", seed: int = 0) -> tuple[StackingModel, DataFrame]:
    """Out-of-fold base predictions → pivot by base → linear meta learner; base
    models are then refitted on all rows.  Returns the model and the OOF table."""
    folds = with_folds(df, k, key, shuffle=True, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
    oof = None
    for name, (kind, params) in bases.items():
        part = oof_predictions(df, kind, params, label, k, key, seed, folds=folds, name=name)
        oof = part if oof is None else oof.unionByName(part)
    names = list(bases)
    wide = oof.groupBy(key, "truth").pivot("base", names).agg(F.first("pred"))
    meta = LinearRegression(featuresCol="__z", labelCol="truth").fit(
        VectorAssembler(inputCols=names, outputCol="__z").transform(wide))
    fitted = {n: M.fit_interval_model(df, kd, labels=[label], params=p) for n, (kd, p) in bases.items()}
    folds.unpersist(blocking=True)
    return StackingModel(fitted, meta, label, names), oof


# ---------------------------------------------------------------------------
# Permutation importance (K9)
# ---------------------------------------------------------------------------
def _draws(n: int, repeats: int, seed: str) -> list[tuple[int, int]]:
    """(a, b) of each repeat, a prime to n: the row of rank r takes the value of rank (a r + b) mod n."""
    rng = random.Random(seed)
    draws = []
    for _ in range(repeats):
        a = rng.randrange(1, 1 << 20)
        while math.gcd(a, n) != 1:
            a = rng.randrange(1, 1 << 20)
        draws.append((a, rng.randrange(n)))
    return draws


def _permuted(ranked: DataFrame, features: Sequence[str], n: int, repeats: int, seed: int) -> DataFrame:
    """Every row of ``ranked`` (__rank) once for each feature and repeat (feature, rep), the feature's value taken from
    another row.  Only the values move: each goes to the rank that takes it, so a row is joined once."""
    slots = {t: f"__v{i}" for i, t in enumerate(dict.fromkeys(ranked.schema[c].dataType for c in features))}
    sent = []
    for i, c in enumerate(features):
        for rep, (a, b) in enumerate(_draws(n, repeats, f"{seed}:{c}")):
            to = F.pmod((F.col("__rank") - F.lit(b)) * F.lit(pow(a, -1, n)), F.lit(n)).cast("long")
            sent.append(F.struct(to.alias("__rank"), F.lit(i).alias("__f"), F.lit(rep).alias("rep"), *[
                (F.col(c) if t == ranked.schema[c].dataType else F.lit(None).cast(t)).alias(v) for t, v in slots.items()]))
    moved = ranked.select(F.explode(F.array(*sent)).alias("s")).select("s.*")
    out = ranked.join(moved, "__rank").withColumns({c: F.when(F.col("__f") == i, F.col(slots[ranked.schema[c].dataType])).otherwise(F.col(c))
                                                    for i, c in enumerate(features)})
    return out.withColumn("feature", F.array(*[F.lit(c) for c in features])[F.col("__f")]).drop("__f", *slots.values())


def permutation_importance(model: M.IntervalModel, df: DataFrame, features: Sequence[str], repeats: int = 10,
                           seed: int = 1, key: str = "id") -> DataFrame:
    """Drop in R² per (feature, label) over ``repeats`` permutations: mean, sd and
    quartiles.  All permuted copies are scored by one ``transform`` and one
    grouped aggregate; the rows as they are, once."""
    n = max(1, df.count())
    # dealt by rank to all tasks: few bytes are many rows to score
    ranked = cut_lineage(_spread(hash_ranked(df, key, seed, "__rank").withColumn("__rank", F.col("__rank") - 1), "__rank"))
    allc = ranked.withColumn("rep", F.lit(0)).withColumn("feature", F.lit("__none__"))
    if features:
        allc = allc.unionByName(_permuted(ranked, features, n, repeats, seed))
    scored = model.transform(allc, key=key, keep=["rep", "feature", *model.labels])
    long = scored.select("feature", "rep", F.explode(F.array(*[
        F.struct(F.lit(lab).alias("label"), F.col(lab).cast("double").alias("y"),
                 F.col(M.OUT.get(lab, f"pred_{lab}")).alias("p")) for lab in model.labels])).alias("s")).select(
        "feature", "rep", "s.*")
    r2 = long.groupBy("feature", "rep", "label").agg(
        (F.lit(1.0) - F.sum(F.pow(F.col("y") - F.col("p"), 2)) /
         (F.sum(F.col("y") * F.col("y")) - F.pow(F.sum("y"), 2) / F.count(F.lit(1)))).alias("r2"))
    ref = r2.filter(F.col("feature") == "__none__").select("label", F.col("r2").alias("r2_ref"))
    drops = r2.filter(F.col("feature") != "__none__").join(ref, "label").withColumn(
        "drop", F.col("r2_ref") - F.col("r2"))
    return drops.groupBy("feature", "label").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"),
        F.percentile("drop", 0.25).alias("q25"), F.percentile("drop", 0.5).alias("q50"),
        F.percentile("drop", 0.75).alias("q75"))
