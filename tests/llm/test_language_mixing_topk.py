import zlib
from collections import defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F

from spanlab.llm import language_id, mixing, top_k

from .conftest import SF, docs_of


def test_language_held_out_accuracy(spark):
    got = language_id.query(spark, SF).collect()
    truth = {r[0]: r[2] for r in docs_of()}
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def test_codes_are_apart():
    for n in (2, 3, 4, 6, 9, 40):
        m = language_id.code_matrix(n)
        assert min((m[i] != m[j]).sum() for i in range(n) for j in range(i)) >= max(1, 2 ** max(0, min(n, 4) - 2))


def test_language_odd_and_empty(odd, make):
    some = make([(k, "the cat and the dog", "en") for k in range(5)] + [(9 + k, "der hund und die katze", "de") for k in range(5)])
    model = language_id.fit(some)
    rows = language_id.predict(odd, model, id_cols=odd.columns).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score_ == 0 for r in rows if not any(c.isalpha() for c in r.text or ""))
    assert all(r.lang_pred in ("en", "de") for r in rows if any(c.isalpha() for c in r.text or ""))
    none = language_id.fit(make([]))
    assert {r.lang_pred for r in language_id.predict(odd, none).collect()} == {"und"}
    one = language_id.fit(make([(1, "solo", "es")]))
    assert {(r.lang_pred, r.score_) for r in language_id.predict(odd.filter("doc_id = 4"), one).collect()} == {("es", 1.0)}
    assert language_id.predict(make([]), model).count() == 0


def brute_targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3 * size[s] for s in capped)) / sum(w[s] for s in free) if free else 0
        more = {s for s in free if w[s] * level > 3 * size[s]}
        if not more:
            return {s: 3 * size[s] if s in capped else w[s] * level for s in names}
        capped |= more


def test_mix_against_brute_force(make):
    rows = [(i, "w " * ((i * 7) % 23), None, [None, "a", "B", "é", "zz", "big"][min(5, i % 11)]) for i in range(400)] + [(1000, None, None, "none"), (1001, "", None, "none")]
    got = {r.doc_id: r for r in mixing.mix(make(rows)).collect()}
    size, taken = defaultdict(int), defaultdict(int)
    for i, t, _, s in rows:
        size[s] += len((t or "").split())
        taken[s] += got[i].taken
        assert got[i].size == len((t or "").split()) and 0 <= got[i].taken <= 3 * got[i].size
    targets = brute_targets(dict(size))
    for s in size:
        assert taken[s] == int(targets[s] + 0.5)
    for i, _, _, s in rows:
        assert got[i].source_size == size[s] and abs(got[i].target - targets[s]) < 1e-5
    again = {r.doc_id: r.taken for r in mixing.mix(make(rows)).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_mixed_documents_odd_and_empty(odd, make):
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mix(make([])).count() == 0
    rows = [(i, "w " * 10, None, "ab"[i % 2]) for i in range(40)]
    out = mixing.mixed_documents(make(rows))
    assert out.columns == make(rows).columns
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert n["a"] in (28, 29) and n["b"] in (11, 12)


def test_top_k_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(top_k.ORACLE).fetchall())
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k.query(spark, SF).collect()) == want


def test_top_k_ties_odd_vectors_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK", 16)
    monkeypatch.setattr(top_k, "QUERIES", 3)
    monkeypatch.setattr(top_k, "STRIPE_BLOCKS", 2)
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(300, 360)] + [(400, [0.5, 0.5])]
    odd = [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (503, [float("nan")] * 6), (600, [float("inf")] * 6), (None, [9.0] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k.top_k(df, F.col("vec_id") % 100 == 0).collect())
    m = np.zeros((len(rows), 6), np.int64)
    for k, (_, v) in enumerate(rows):
        m[k, :len(v)] = np.floor(1024 * np.array(v))
    want = []
    for k, (i, _) in enumerate(rows):
        if i % 100 == 0:
            s = m @ m[k]
            best = sorted((-int(s[j]), rows[j][0]) for j in range(len(rows)) if j != k)[:10]
            want += [(i, n + 1, v, -x) for n, (x, v) in enumerate(best)]
    assert got == sorted(want)
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    two = df.filter("vec_id in (100, 101)")
    assert [(r.query_id, r.vec_id) for r in top_k.top_k(two, F.col("vec_id") % 100 == 0).collect()] == [(100, 101)]
