"""Near-duplicate groups by SuperMinHash.

A signature slot is the minimum over the shingles of ``j + r``: in step ``j`` every shingle sends a fresh uniform
``r`` to the slot that its own random permutation has at place ``j``.  A shingle reaches each slot once, so slots are
anti-correlated and the estimate varies less than with independent hashes; a text stops as soon as all its slots are
filled, as later values can only be larger (two or three steps for a text of some hundred shingles).  Bands of
signatures give candidates, links are confirmed on full shingle sets, and linked texts are grouped by union-find as
rounds of label joins (``links.py``).  With 32 bands of 4 rows a pair of similarity 0.8 shares no band with
probability 5e-8.

Defined results: texts without words (null, empty, only white space) have an empty set and are linked with nothing; a
text of fewer words than a shingle has its whole sequence as one; rows with a null id are never linked and are kept;
rows that share an id are linked by their own texts; ``deduplicated`` chooses among rows, not ids, and keeps other
columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, mix64, numbered
from .links import link_texts

SLOTS, ROWS = 128, 4
SHINGLE, PERCENT = 5, 80
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def superminhash(sets: list[np.ndarray], m: int = SLOTS) -> np.ndarray:
    """Signatures (texts x m) of sets of uint64; a slot holds ``j`` and 32 bits of ``r`` in one integer."""
    sig = np.full((len(sets), m), ~np.uint64(0), np.uint64)
    flat = sig.reshape(-1)
    e = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    d = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    perm = np.empty((len(e), m), np.uint8)
    perm[:] = np.arange(m, dtype=np.uint8)
    at = np.arange(len(e))
    for j in range(m):
        if not len(e):
            break
        x = mix64(e + np.uint64((j + 1) * int(GOLDEN) % 2**64))
        k = j + (((x & _LOW) * np.uint64(m - j)) >> _32).astype(np.int64)
        slot = perm[at, k]
        perm[at, k] = perm[:, j]  # place j is not looked at again
        np.minimum.at(flat, d * m + slot, (np.uint64(j) << _32) | (x >> _32))
        open_ = (sig.max(1) >= np.uint64((j + 1) << 32))[d]
        left = int(open_.sum())
        if left < 0.8 * len(e):
            e, d, perm, at = e[open_], d[open_], perm[open_], np.arange(left)
    return sig


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: ``component_id`` is the smallest id reachable over
    links, the row's own for texts without words."""
    classes, sigs, _ = link_texts(docs, superminhash, shingle, percent, ROWS, True, id_col, text_col)
    rows = sigs.select("id", "n", "k1", "k2", F.when((F.col("n") > 0) & F.col("id").isNotNull(), 1).alias("some"))
    out = rows.join(classes.withColumn("some", F.lit(1)), ["k1", "k2", "some"], "left")
    comp = F.coalesce("comp", "id")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(comp == F.col("id"), F.lit(True)).alias("kept"))


def near_links(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified links (x, y) between the representatives of classes of equal sets, enough to connect every group."""
    return link_texts(docs, superminhash, shingle, percent, ROWS, True, id_col, text_col)[2]


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group (the smallest id, of rows that share it the first), all rows with a null id, all columns."""
    rows, row = numbered(docs)
    some = rows.filter(F.col(id_col).cast("long").isNotNull())
    ids = some.select(F.col(row).alias("doc_id"), F.col(id_col).cast("long").alias("id"))
    members = near_groups(some, shingle, percent, row, text_col).filter("n_shingles > 0").select("doc_id", "component_id").join(ids, "doc_id")
    best = (members.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("best"), F.count(F.lit(1)).alias("c"))
            .filter("c > 1").select("component_id", F.col("best.doc_id").alias("best")))
    gone = members.join(best, "component_id").filter("doc_id <> best").select(F.col("doc_id").alias("__gone"))
    return rows.join(gone, F.col(row) == F.col("__gone"), "left_anti").select(*docs.columns)


def query(spark, sf_dir):
    from .common import documents
    return near_groups(documents(spark, sf_dir), shingle=4)
