"""MinHash fingerprints of texts.

A fingerprint has 128 places; a place is the minimum of one universal hash ``a * x + b`` (modulo 2**64, odd ``a``)
over the 64-bit hashes of the text's word shingles, cut to 16 bits after mixing.  All hashes of a chunk of texts are
computed in numpy with ``minimum.reduceat``.  The likeness of two fingerprints is the share of equal places.  Bands
of signatures join similar texts in Spark and their Jaccard similarity is verified on full sets (``near_links``).

``edited`` fingerprints a text and its edited text, whose last quarter is taken from the next text in ascending id
order: one range shuffle, a pass over the sorted partitions that keeps one text behind, and a join of each
partition's last text with the first of the next partition.

Defined results: null text counts as empty; a text without words has the empty fingerprint, which is like another
empty one (1) and unlike any other (0); null ids sort first, rows of equal id by text; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, mix64, random_words, shingle_sets, stored, text_bytes
from .links import link_texts

PLACES, ROWS = 128, 4
SHINGLE, PERCENT = 5, 80
_A, _B = random_words(41, PLACES, odd=True), random_words(43, PLACES)


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of all hashes over each set (texts x places); empty sets keep the largest value."""
    sig = np.full((len(sets), PLACES), ~np.uint64(0), np.uint64)
    some = np.flatnonzero([len(s) for s in sets])
    if len(some):
        x = np.concatenate([sets[i] for i in some])
        at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in some])[:-1]])
        for j in range(PLACES):
            sig[some, j] = np.minimum.reduceat(x * _A[j] + _B[j], at)
    return sig


def fingerprint(texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """16-bit places of every text (texts x places) and whether it has words."""
    sets = shingle_sets(*text_bytes(pa.array(texts, pa.string())), shingle, True)
    return (mix64(minhash(sets)) & np.uint64(0xFFFF)).astype(np.uint16), np.array([len(s) > 0 for s in sets], bool)


def _hex(places: np.ndarray, some: np.ndarray) -> list[str]:
    return [p.astype(">u2").tobytes().hex() if s else "" for p, s in zip(places, some)]


def _like(a, a_some, b, b_some) -> np.ndarray:
    return np.where(a_some & b_some, (a == b).mean(1) if len(a) else 0.0, (a_some == b_some).astype(float))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal places of two fingerprint columns."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(PLACES - 1)), F.lit(0),
                       lambda n, k: n + F.when(F.substring(a, 4 * k + 1, F.lit(4)) == F.substring(b, 4 * k + 1, F.lit(4)), 1).otherwise(0))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(same / F.lit(float(PLACES)))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every text."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "__text"):
                got = _hex(*fingerprint([t or "" for t in part.column("__text").to_pylist()], shingle))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.string())], names=[id_col, "fingerprint"])
    sel = docs.select(id_col, F.col(text_col).alias("__text"))
    return sel.mapInArrow(run, f"`{id_col}` {sel.schema[0].dataType.simpleString()}, fingerprint string")


def near_links(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified links (x, y) of similar texts: banded signatures joined in Spark, Jaccard similarity checked."""
    return link_texts(docs, minhash, shingle, percent, ROWS, True, id_col, text_col)[2]


def edit(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many (or all) of the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _rows(ids, texts, following, shingle, known=None):
    """Result columns of texts whose next texts are known; ``known`` are fingerprints of texts + the last's next."""
    edited = [edit(t, f) for t, f in zip(texts, following)]
    fp, some = known if known is not None else fingerprint([*texts, following[-1]], shingle)
    nfp, nsome = fp[1:], some[1:]
    fp, some = fp[:-1], some[:-1]
    efp, esome = fingerprint(edited, shingle)
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()), pa.array(_hex(fp, some), pa.string()),
            pa.array(_hex(efp, esome), pa.string()), pa.array(_like(fp, some, efp, esome), pa.float64()), pa.array(_like(fp, some, nfp, nsome), pa.float64())]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row; the
    text after the last is the first."""
    names = [*NAMES, "part", "head", "tail"]

    def run(batches):
        pid = TaskContext.get().partitionId()
        ids, texts, held = [], [], None  # held: fingerprints of the row that waits for its next

        def none(n):
            return pa.nulls(n, pa.string())

        first = True
        for batch in batches:
            for part in chunks(batch, "text"):
                new = [t or "" for t in part.column("text").to_pylist()]
                if first:  # the head goes out by itself, the row follows when its next is known
                    yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())),
                                                      pa.array([pid], pa.int32()), pa.array([new[0]], pa.string()), none(1)], names=names)
                    first = False
                ids, texts = [*ids, *part.column("id").to_pylist()], [*texts, *new]
                got = fingerprint(new, shingle)
                known = got if held is None else tuple(np.concatenate([h, g]) for h, g in zip(held, got))
                n = len(texts) - 1
                if n:
                    yield pa.RecordBatch.from_arrays([*_rows(ids[:-1], texts[:-1], texts[1:], shingle, known), pa.array([pid] * n, pa.int32()), none(n), none(n)], names=names)
                ids, texts, held = ids[-1:], texts[-1:], tuple(k[-1:] for k in known)
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())),
                                              pa.array([pid], pa.int32()), none(1), pa.array(texts, pa.string())], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    done = stored(rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, f"{SCHEMA}, part int, head string, tail string"))
    # One text for each partition waits for the head of the next partition that has rows (after the last: the first).
    heads = done.filter("head is not null").select("part", "head")
    order = Window.orderBy("part")
    parts = heads.select("part")
    least = F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))  # a row per partition
    parts = parts.select("part", F.coalesce(F.lead("part").over(order), least).alias("after"))
    ends = (done.filter("tail is not null").select("doc_id", "tail", "part").join(parts, "part")
            .join(heads.withColumnRenamed("part", "after"), "after"))

    def finish(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(_rows(*(row.column(c).to_pylist() for c in ("doc_id", "tail", "head")), shingle), names=NAMES)

    whole = done.filter("head is null and tail is null").select(*NAMES)
    return whole.unionByName(ends.select("doc_id", "tail", "head").mapInArrow(finish, SCHEMA))


def query(spark, sf_dir):
    from .common import documents
    return edited(documents(spark, sf_dir))
