"""Exact top-k search by inner product over norm-sorted blocks.

Vectors are rotated by the eigenvectors of their second-moment matrix (the right singular vectors of the table), so
the first coordinates hold most of every inner product.  Candidates are ranked by descending length and packed into
blocks.  A block of queries meets a stripe of candidate blocks in that order and drops

* a block, once the product of its longest vector's length and the query's cannot reach the query's k-th score,
* a candidate, once a partial sum over the first coordinates plus the product of the lengths of the remaining
  coordinates (Cauchy-Schwarz) cannot reach it.

What is left is scored exactly in integers.  Starting thresholds come from the block of longest candidates.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a
null id; a shorter vector counts as padded with zeros; equal scores are ranked by id; queries with fewer candidates
than k get them all; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, stored

BLOCK = 4096          # candidates of a block
QUERIES = 1024        # queries of a block
STRIPE_BLOCKS = 16    # candidate blocks that one task reads in order
PARTIAL = (0.125, 0.25, 0.5)  # shares of the coordinates after which bounds are looked at
SLACK = 1e-9          # of the lengths' product, for rounding of the rotated sums


def scaled(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null where the vector takes no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(vec.isNotNull() & (F.size(vec) > 0) & ~bad, F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(lists, dim: int) -> np.ndarray:
    m = np.zeros((len(lists), dim), np.int64)
    for k, v in enumerate(lists):
        m[k, :len(v)] = v
    return m


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors (columns, largest eigenvalue first) of the sum of x xT: dim x dim sums per task, added by Spark."""
    def moments(batches):
        s = np.zeros((dim, dim))
        for b in batches:
            x = _matrix(b.column("v").to_pylist(), dim).astype(float)
            s += x.T @ x
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": pa.array(s.ravel())})
    rows = vectors.select("v").mapInArrow(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((dim, dim))
    for r in rows:
        m[r.i, r.j] = r.s
    return np.linalg.eigh(m)[1][:, ::-1]


def _pack(vectors: DataFrame, size: int, dim: int) -> DataFrame:
    """Blocks of ``size`` vectors by descending length: (block, n, longest, ids, data)."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "n": [len(pdf)], "longest": [float(pdf["norm"].max())],
                             "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "data": [_matrix(pdf["v"], dim).tobytes()]})
    r = ranked(vectors, [F.col("norm").desc(), F.col("id")], "rank").withColumn("block", F.floor(F.col("rank") / size).cast("long"))
    return stored(r.groupBy("block").applyInPandas(pack, "block long, n long, longest double, ids binary, data binary"))


class Search:
    """Best candidates of a block of queries, block after block."""

    def __init__(self, ids: bytes, data: bytes, rot: np.ndarray, k: int, floor: np.ndarray | None = None):
        dim = len(rot)
        self.ids, self.x, self.rot, self.k = np.frombuffer(ids, np.int64), np.frombuffer(data, np.int64).reshape(-1, dim), rot, k
        self.y = self.x.astype(float) @ rot
        self.cuts = sorted({max(1, int(dim * p)) for p in PARTIAL})
        self.rest = {c: np.sqrt((self.y[:, c:] ** 2).sum(1)) for c in [0, *self.cuts]}
        n = len(self.ids)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n  # scores, ids
        self.floor = np.full(n, -np.inf) if floor is None else floor.astype(float)
        self.exact_in_float = None

    def block(self, ids: bytes, data: bytes) -> None:
        ids = np.frombuffer(ids, np.int64)
        x = np.frombuffer(data, np.int64).reshape(len(ids), -1)
        y = x.astype(float) @ self.rot
        rest = {c: np.sqrt((y[:, c:] ** 2).sum(1)) for c in [0, *self.cuts]}
        live = self.rest[0] * rest[0].max() * (1 + SLACK) >= self.floor
        for q0 in range(0, len(self.ids), 256):
            q = q0 + np.flatnonzero(live[q0:q0 + 256])
            if not len(q):
                continue
            slack = SLACK * np.outer(self.rest[0][q], rest[0]) + 1e-6
            part, done = np.zeros((len(q), len(ids))), 0
            cols = np.arange(len(ids))  # candidates that some query of the group still needs
            for c in self.cuts:
                part = part + self.y[q, done:c] @ y[cols, done:c].T
                done = c
                open_ = part + np.outer(self.rest[c][q], rest[c][cols]) + slack[:, cols] >= self.floor[q, None]
                use = open_.any(0)
                cols, part, open_ = cols[use], part[:, use], open_[:, use]
            if not len(cols):
                continue
            top = float(np.abs(self.x[q]).max(initial=0)) * float(np.abs(x[cols]).max(initial=0)) * x.shape[1]
            if top < 2.0 ** 52:  # sums of integers are exact in doubles
                score = (self.x[q].astype(float) @ x[cols].astype(float).T).astype(np.int64)
            else:
                score = self.x[q] @ x[cols].T
            open_ &= (score >= self.floor[q, None]) & (ids[cols][None] != self.ids[q][:, None])
            for k, row in enumerate(q):
                hit = np.flatnonzero(open_[k])
                if len(hit):
                    self._merge(row, score[k, hit], ids[cols[hit]])

    def _merge(self, row: int, score: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.best[row][0], score]), np.concatenate([self.best[row][1], ids])
        top = np.lexsort((i, -s))[:self.k]
        self.best[row] = s[top], i[top]
        if len(top) == self.k:
            self.floor[row] = max(self.floor[row], s[top[-1]])


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` holds for, its ``k`` other rows of highest
    inner product of the scaled integer vectors."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vec_col), scale).alias("v"), is_query.alias("q")).filter("v is not null and id is not null")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = stored(rows.withColumn("norm", norm))
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    schema = "query_id long, vec_id long, score long"
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rot = spark.sparkContext.broadcast(rotation(rows, dim))  # dim x dim
    cand = _pack(rows, BLOCK, dim)
    ask = _pack(rows.filter("q"), QUERIES, dim)
    # Starting thresholds: the k-th score in the block of longest candidates (one block, BLOCK vectors).
    longest = cand.filter("block = 0").select(F.col("ids").alias("cids"), F.col("data").alias("cdata"), F.lit(0).alias("one"))

    def start(batches):
        for b in batches:
            for r in b.to_pylist():
                s = Search(r["ids"], r["data"], rot.value, k)
                s.block(r["cids"], r["cdata"])
                yield pa.RecordBatch.from_pydict({"qb": pa.array([r["block"]], pa.int64()), "qids": pa.array([r["ids"]], pa.binary()), "qdata": pa.array([r["data"]], pa.binary()),
                                                  "floor": pa.array([s.floor.tobytes()], pa.binary()), "lowest": [float(s.floor.min())], "qlongest": [r["longest"]]})

    first = ask.withColumn("one", F.lit(0)).join(F.broadcast(longest), "one").select("block", "ids", "data", "longest", "cids", "cdata")
    ask = stored(first.mapInArrow(start, "qb long, qids binary, qdata binary, floor binary, lowest double, qlongest double"))
    pairs = (cand.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(max(0, ask.count() - 1))))).withColumn("qb", F.col("qb").cast("long"))
             .select("qb", "block", "longest", "ids", "data"))
    bound = ask.select("qb", "lowest", "qlongest")
    pairs = (pairs.join(F.broadcast(bound), "qb").filter(F.col("longest") * F.col("qlongest") * (1 + SLACK) >= F.col("lowest"))
             .select("qb", F.floor(F.col("block") / STRIPE_BLOCKS).alias("stripe"), "block", "ids", "data"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left):
            q = left.iloc[0]
            s = Search(q["qids"], q["qdata"], rot.value, k, np.frombuffer(q["floor"], float).copy())
            for b in right.sort_values("block").itertuples():
                s.block(b.ids, b.data)
            for i, (score, ids) in zip(s.ids.tolist(), s.best):
                out.append(pd.DataFrame({"query_id": i, "vec_id": ids, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    stripes = pairs.select(F.col("qb").alias("of"), F.col("stripe").alias("part")).distinct()
    stripes = stripes.join(ask.withColumnRenamed("qb", "of"), "of")
    got = stripes.groupBy("of", "part").cogroup(pairs.groupBy("qb", "stripe")).applyInPandas(search, schema)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return got.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def query(spark, sf_dir):
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
