"""Incremental, reversible line dedup on sharded cuckoo filters backed by exact reference counts.

A line's key is the line without white space (space, 0x09-0x0D) at both ends, A-Z in lower case; keys of at least
``min_chars`` characters count.  A ``LineIndex`` holds three tables in the shared folder:

``postings``  (doc_id, key)                     the 128-bit keys of every document, each once per doc_id
``refs``      (key, n_docs, max_doc)            exact reference counts
``filters``   (shard, table)                    one cuckoo filter for each shard of the keys in ``refs``

*Insertion* asks the shard's filter about each new key (one row per key, counted before the shuffle, so a line held
by a third of all documents is one row per task).  Keys that the filter does not know are new for certain and are
appended without looking at ``refs``; only the others are joined with the exact table.  *Deletion* lowers the counts,
finds the next holder of keys whose largest document went, and takes the fingerprints of keys at zero out of the
filters.  *Cleaning* drops a line when its key is in at least ``min_docs`` documents and another document is the
largest holder.  Tasks screen their lines with cuckoo filters of the droppable keys while these filters are below
``SCREEN_BYTES`` in all (only texts with a suspect go on, the rest are ready); above it every counted line is a
suspect.  Either way the exact table decides, so results are the same.

Defined results: null text counts as one empty line; a null doc_id's text counts nothing and stays whole; rows that
share a doc_id count as one document and keep or lose lines alike; an empty table gives an empty index; other columns of the
documents are kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, mix64, stored

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of a shard at creation; the number of shards follows the number of keys.
SHARD_KEYS = 100_000
SCREEN_BYTES = 16 << 20
SLOTS = 4
_WS = " \t\n\x0b\x0c\r"


class FilterFull(Exception):
    """No room after the allowed number of moves: the shard is built again with twice the buckets."""


class CuckooFilter:
    """Approximate set of 64-bit hashes with deletion: 16-bit fingerprints in buckets of four, each hash with two
    possible buckets that are each other's image under the fingerprint."""

    MOVES = 500

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def for_keys(cls, n: int) -> "CuckooFilter":
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, n) / (0.8 * SLOTS))))))

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        t = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(t), t)

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h: np.ndarray):
        fp = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        a = (mix64(h) & self.mask).astype(np.int64)
        return fp, a, self._other(a, fp)

    def _other(self, bucket, fp):
        return bucket ^ (mix64(np.asarray(fp).astype(np.uint64)) & self.mask).astype(np.int64)

    def contains(self, h: np.ndarray) -> np.ndarray:
        fp, a, b = self._places(h)
        return ((self.table[a] == fp[:, None]) | (self.table[b] == fp[:, None])).any(1)

    def insert(self, h: np.ndarray) -> None:
        """Insert hashes that are not in the set (each once)."""
        fp, a, b = self._places(h)
        left = np.arange(len(h))
        for where in (a, b, a, b):
            for s in range(SLOTS):
                free = left[self.table[where[left], s] == 0]
                _, first = np.unique(where[free], return_index=True)
                put = free[first]
                self.table[where[put], s] = fp[put]
                left = np.setdiff1d(left, put, assume_unique=True)
        rng = np.random.default_rng(len(h))
        for k in left.tolist():
            f, at = fp[k], int(a[k])
            for _ in range(self.MOVES):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = f
                    break
                s = int(rng.integers(SLOTS))
                f, self.table[at, s] = self.table[at, s], f
                at = int(self._other(np.array([at]), np.array([f]))[0])
            else:
                raise FilterFull

    def remove(self, h: np.ndarray) -> None:
        """Remove hashes that are in the set."""
        fp, a, b = self._places(h)
        for f, x, y in zip(fp.tolist(), a.tolist(), b.tolist()):
            for at in (x, y):
                hit = np.flatnonzero(self.table[at] == f)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break


def _hash_of(keys) -> np.ndarray:
    """First 8 bytes of 16-byte keys."""
    return np.frombuffer(b"".join(k[:8] for k in keys), "<u8")


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> tuple[list[str], list[bytes | None]]:
    """Lines of a text and the key of each (None: too short to count)."""
    lines = (text or "").split("\n")
    keys: list[bytes | None] = []
    for x in lines:
        x = x.strip(_WS)
        keys.append(xxhash.xxh3_128_digest(x.encode().lower()) if len(x) >= min_chars else None)
    return lines, keys


def postings_of(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                ids, keys = [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    got = set(line_keys(t, min_chars)[1])
                    got.discard(None)
                    ids += [d] * len(got)
                    keys += got
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "doc_id long, key binary").dropDuplicates(["doc_id", "key"])


def _shard(shards: int):
    """Shard of a key by its bytes 9 to 12; ``shards`` is a power of two."""
    return F.conv(F.hex(F.substring("key", 9, 4)), 16, 10).cast("long").bitwiseAND(F.lit(shards - 1)).cast("int")


def _shards_for(n: int, least: int = 1) -> int:
    while least * SHARD_KEYS < n:
        least *= 2
    return least


def _counted(postings: DataFrame, shards: int) -> DataFrame:
    return (postings.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc"))
            .withColumn("shard", _shard(shards)))


def _filters(keys: DataFrame) -> DataFrame:
    """A new filter for each shard of (shard, key)."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h, n = _hash_of(pdf["key"]), len(pdf)
        while True:
            f = CuckooFilter.for_keys(n)
            try:
                f.insert(h)
                return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "table": [f.dump()]})
            except FilterFull:
                n *= 2
    return keys.select("shard", "key").groupBy("shard").applyInPandas(build, "shard int, table binary")


@dataclass
class LineIndex:
    """The three tables and the parameters of an index; every change gives a new index."""

    spark: SparkSession
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> "LineIndex":
        post = stored(postings_of(docs, id_col, text_col, min_chars))
        shards = _shards_for(post.count(), 16)
        refs = stored(_counted(post, shards))
        return cls(docs.sparkSession, post, refs, stored(_filters(refs)), shards, min_chars)

    def _with_filter(self, rows: DataFrame, apply, schema: str) -> DataFrame:
        """``apply(rows of a shard, its filter or None)`` for every shard that has rows or a filter."""
        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return apply(left, CuckooFilter.load(right["table"].iloc[0]) if len(right) else None)
        return rows.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(run, schema)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> "LineIndex":
        """Add documents whose ids are not in the index."""
        post = stored(postings_of(docs, id_col, text_col, self.min_chars))

        def ask(rows, f):
            rows["maybe"] = f.contains(_hash_of(rows["key"])) if f is not None and len(rows) else False
            return rows
        schema = "key binary, n_docs long, max_doc long, shard int, maybe boolean"
        asked = stored(self._with_filter(_counted(post, self.shards).select("key", "n_docs", "max_doc", "shard"), ask, schema))
        old = self.refs.select("key", F.col("n_docs").alias("__n"), F.col("max_doc").alias("__m"))
        known = asked.filter("maybe").join(old, "key", "left")
        known = known.withColumn("new", F.col("__n").isNull())
        fresh = asked.filter("not maybe").select("key", "n_docs", "max_doc", "shard").withColumn("new", F.lit(True))
        changed = stored(fresh.unionByName(known.select("key", (F.col("n_docs") + F.coalesce("__n", F.lit(0))).alias("n_docs"),
                                                        F.greatest("max_doc", "__m").alias("max_doc"), "shard", "new")))
        refs = stored(self.refs.join(changed.filter("not new").select("key"), "key", "left_anti").unionByName(changed.drop("new")))
        return self._next(self.postings.unionByName(post), refs, changed.filter("new").select("shard", "key"), None)

    def delete(self, ids: DataFrame) -> "LineIndex":
        """Take documents out: ``ids`` has a column doc_id.  Counts, largest holders and filters are as if they had
        never been inserted."""
        ids = ids.select(F.col("doc_id").cast("long")).distinct()
        gone = stored(self.postings.join(ids, "doc_id", "left_semi"))
        post = self.postings.join(ids, "doc_id", "left_anti")
        less = stored(gone.groupBy("key").agg(F.count(F.lit(1)).alias("__less"), F.max("doc_id").alias("__max")))
        hit = self.refs.join(less, "key")
        lost = hit.filter("n_docs > __less and max_doc = __max").select("key")
        holders = post.join(lost, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("__next"))
        kept = (hit.filter("n_docs > __less").join(holders, "key", "left")
                .select("key", (F.col("n_docs") - F.col("__less")).alias("n_docs"), F.coalesce("__next", "max_doc").alias("max_doc"), "shard"))
        refs = stored(self.refs.join(less.select("key"), "key", "left_anti").unionByName(kept))
        dead = hit.filter("n_docs = __less").select("shard", "key")
        return self._next(stored(post), refs, None, dead)

    def _next(self, postings, refs, add: DataFrame | None, remove: DataFrame | None) -> "LineIndex":
        """Filters after adding or removing keys; a shard whose filter is full is built again from ``refs``."""
        rows = add if add is not None else remove
        inserting = add is not None

        def change(rows, f):
            h = _hash_of(rows["key"]) if len(rows) else np.zeros(0, np.uint64)
            shard = int(rows["shard"].iloc[0]) if len(rows) else -1
            try:
                if inserting:
                    f = f or CuckooFilter.for_keys(len(h))
                    f.insert(h)
                elif f is not None:
                    f.remove(h)
                return pd.DataFrame({"shard": [shard], "table": [f.dump() if f else b""]})
            except FilterFull:
                return pd.DataFrame({"shard": [shard], "table": [None]})

        done = stored(self._with_filter(rows, change, "shard int, table binary").filter("shard >= 0"))
        full = done.filter("table is null").select("shard")
        again = _filters(refs.join(full, "shard", "left_semi"))
        kept = self.filters.join(done.select("shard"), "shard", "left_anti")
        filters = stored(kept.unionByName(done.filter("length(table) > 0")).unionByName(again))
        return LineIndex(self.spark, postings, refs, filters, self.shards, self.min_chars)

    # --- cleaning ---

    def droppable(self, min_docs: int = MIN_DOCS) -> DataFrame:
        return self.refs.filter(F.col("n_docs") >= min_docs)

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
        """All rows and columns of ``docs``, ``text_col`` without the dropped lines, plus n_lines (before) and
        n_dropped as the last two columns (with an underscore added where ``docs`` has the name).  A text that loses all its lines is empty; null text stays null."""
        drop = stored(self.droppable(min_docs).select("key", "max_doc"))
        shards = _shards_for(drop.count())
        screens = stored(_filters(drop.withColumn("shard", _shard(shards))))
        size = screens.agg(F.sum(F.length("table"))).first()[0] or 0
        tables = None
        if size <= SCREEN_BYTES:
            tables = self.spark.sparkContext.broadcast((shards, {r[0]: bytes(r[1]) for r in screens.collect()}))
        rest = [c for c in docs.columns if c != text_col]
        rows = (docs.withColumn("__row", F.struct(*rest)).select("__row", F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t")))
        suspects = stored(self._suspects(rows, tables))
        sure = (suspects.filter("__keys is not null").select("__rid", "__id", F.explode("__keys").alias("key"))
                .join(drop.select("key", "max_doc"), "key").filter("__id <> max_doc")
                .groupBy("__rid").agg(F.collect_set("key").alias("__drop")))
        ready = suspects.filter("__keys is null").select("__row", "__t", "__n", F.lit(0).cast("long").alias("__x"))
        cut = self._cut(suspects.filter("__keys is not null").join(sure, "__rid", "left").select("__row", "__t", "__n", "__drop"))
        out = ready.unionByName(cut)
        cols = [F.col("__t").alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in docs.columns]
        return out.select(*cols, F.col("__n").alias(free("n_lines", docs.columns)), F.col("__x").alias(free("n_dropped", docs.columns)))

    def _suspects(self, rows: DataFrame, tables) -> DataFrame:
        """Adds a row number, the number of lines, and the keys of lines that may have to go (null: none)."""
        min_chars = self.min_chars
        shape = rows.withColumn("__rid", F.monotonically_increasing_id())

        def run(batches: Iterator[pa.RecordBatch]):
            n_shards, filters = 1, None
            if tables is not None:
                n_shards, filters = tables.value[0], {k: CuckooFilter.load(t) for k, t in tables.value[1].items()}
            for b in batches:
                for lo in range(0, b.num_rows, 1024):
                    part = b.slice(lo, 1024)
                    n, sets = [], []
                    for d, t in zip(part.column("__id").to_pylist(), part.column("__t").to_pylist()):
                        lines, keys = line_keys(t, min_chars)
                        n.append(len(lines))
                        got = set(keys) if d is not None else set()
                        got.discard(None)
                        sets.append(list(got))
                    if filters is not None:
                        flat = [k for s in sets for k in s]
                        hit = np.zeros(len(flat), bool)
                        if flat and filters:
                            h = _hash_of(flat)
                            shard = np.frombuffer(b"".join(k[8:12] for k in flat), ">u4") & (n_shards - 1)
                            for k, f in filters.items():
                                own = np.flatnonzero(shard == k)
                                hit[own] = f.contains(h[own])
                        at, kept = 0, []
                        for s in sets:
                            kept.append([k for k, y in zip(s, hit[at:at + len(s)]) if y])
                            at += len(s)
                        sets = kept
                    keys = pa.array([s or None for s in sets], pa.list_(pa.binary()))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), keys], names=[*part.schema.names, "__n", "__keys"])
        schema = T.StructType([*shape.schema, T.StructField("__n", T.LongType()), T.StructField("__keys", T.ArrayType(T.BinaryType()))])
        return shape.mapInArrow(run, schema)

    def _cut(self, rows: DataFrame) -> DataFrame:
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]):
            for b in batches:
                for lo in range(0, b.num_rows, 1024):
                    part = b.slice(lo, 1024)
                    texts, gone = [], []
                    for t, drop in zip(part.column("__t").to_pylist(), part.column("__drop").to_pylist()):
                        if drop:
                            drop = set(drop)
                            lines, keys = line_keys(t, min_chars)
                            kept = [x for x, k in zip(lines, keys) if k not in drop]
                            gone.append(len(lines) - len(kept))
                            t = "\n".join(kept)
                        else:
                            gone.append(0)
                        texts.append(t)
                    yield pa.RecordBatch.from_arrays([part.column("__row"), pa.array(texts, pa.string()), part.column("__n"), pa.array(gone, pa.int64())],
                                                     names=["__row", "__t", "__n", "__x"])
        schema = T.StructType([*rows.select("__row", "__t", "__n").schema, T.StructField("__x", T.LongType())])
        return rows.mapInArrow(run, schema)


ORACLE = r"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
k AS (SELECT *, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.keeper AS dropped FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def query(spark, sf_dir):
    from .common import documents
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = LineIndex.build(docs).clean(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
