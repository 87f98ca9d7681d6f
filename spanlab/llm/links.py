"""Links between texts from banded signatures: candidates, exact verification on full shingle sets, components.

Texts with equal shingle sets form a class first (one row per class and task leaves the shuffle), so exact copies are
never compared.  Classes that share a band are candidates.  A bucket is not expanded into pairs: each member is
compared with the bucket's smallest member and verified links are merged; what then lies outside a bucket's largest
component (strays) is compared with the other members.  Two exact bounds stand in front of every comparison: the sizes
of the sets, and a parity sketch.  The sketch has a bit for each of 512 hash values, set if an odd number of shingles
has it; two sketches differ in at most as many bits as the sets differ in shingles, so a pair whose sketches differ in
too many bits cannot be similar.  Every candidate pair thus ends verified, excluded by a bound, or inside one component.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, shingle_sets, stored, text_bytes

SKETCH_WORDS = 8
_SALT = np.uint64(0x5851F42D4C957F2D)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set of uint64."""
    a = mix64(s).sum(dtype=np.uint64)
    b = mix64(s ^ _SALT).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` slots of every signature (texts x bands)."""
    n, m = sig.shape
    parts = mix64(sig.reshape(n, m // rows, rows) + np.arange(rows, dtype=np.uint64) * _SALT)
    key = parts[:, :, 0].copy()
    for j in range(1, rows):
        key = mix64(key * _SALT + parts[:, :, j])
    return mix64(key + np.arange(m // rows, dtype=np.uint64)).astype(np.int64)


def parity_sketch(sets: list[np.ndarray]) -> np.ndarray:
    """SKETCH_WORDS int64 for each set: the parity of its shingles by hash value."""
    bits = 64 * SKETCH_WORDS
    at = np.repeat(np.arange(len(sets)) * bits, [len(x) for x in sets])
    value = (mix64((np.concatenate(sets) if sets else np.zeros(0, np.uint64)) ^ _SALT) >> np.uint64(7)).astype(np.int64) % bits
    odd = (np.bincount(at + value, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sets), bits), axis=1, bitorder="little").view("<i8")


def signatures(docs: DataFrame, sign: Callable, shingle: int, rows: int, lower: bool, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, bands, p): set size, set key, band keys and parity sketch of every text; texts without words
    have n = 0 and no bands."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = shingle_sets(*text_bytes(part.column("text")), shingle, lower)
                keys = np.array([set_key(s) for s in sets], np.int64).reshape(-1, 2)
                n = np.array([len(s) for s in sets], np.int64)
                bands = band_keys(sign(sets), rows)
                lists = pa.array([b if k else None for b, k in zip(list(bands), n)], pa.list_(pa.int64()))
                sketch = pa.array(list(parity_sketch(sets)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n), pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists, sketch],
                                                 names=["id", "n", "k1", "k2", "bands", "p"])
    rows_ = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows_.mapInArrow(run, "id long, n long, k1 long, k2 long, bands array<long>, p array<long>")


def class_sets(wanted: DataFrame, docs: DataFrame, shingle: int, lower: bool, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, set) of the classes ``wanted`` (id, k1, k2): sorted shingle hashes as bytes, from the whole texts."""
    # one plan at every size: a sort-merge join, whatever the number of wanted classes
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(wanted.hint("merge"), "id")

    def sets_of(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = shingle_sets(*text_bytes(part.column("text")), shingle, lower)
                keys = [set_key(s) for s in sets]
                # another row may share the id: only the text of the class itself counts
                own = [k == w for k, w in zip(keys, zip(part.column("k1").to_pylist(), part.column("k2").to_pylist()))]
                take = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([keys[i][0] for i in take], pa.int64()), pa.array([keys[i][1] for i in take], pa.int64()),
                                                  pa.array([sets[i].tobytes() for i in take], pa.binary())], names=["k1", "k2", "set"])

    sets = texts.select("id", "k1", "k2", "text").mapInArrow(sets_of, "k1 long, k2 long, set binary")
    return stored(sets.dropDuplicates(["k1", "k2"]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) of structs (id, k1, ...), those whose full sets meet the similarity."""
    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    p = pairs.select(F.col("a.id").alias("x"), F.col("b.id").alias("y"), F.col("a.k1").alias("a1"), F.col("a.k2").alias("a2"), F.col("b.k1").alias("b1"), F.col("b.k2").alias("b2"))
    p = p.join(sets.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("set").alias("sa")), ["a1", "a2"])
    p = p.join(sets.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("set").alias("sb")), ["b1", "b2"])
    return stored(p.select("x", "y", "sa", "sb").mapInArrow(compare, "x long, y long"))


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, comp): smallest id of the component of every id in ``edges`` (x, y).  Minimum of the neighbours' labels
    and pointer jumping in turn until nothing changes; after ``rounds`` rounds, where given, labels may still differ
    inside a component (equal labels always mean one component)."""
    both = stored(edges.select("x", "y").union(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = stored(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("comp")))
    while True:
        near = (both.join(labels.withColumnRenamed("id", "y"), "y").groupBy(F.col("x").alias("id")).agg(F.min("comp").alias("m")))
        step = labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("root"))
        new = stored(step.join(jump, "comp", "left").select("id", "old", F.least("comp", F.coalesce("root", "comp")).alias("comp")))
        labels = new.select("id", "comp")
        rounds = None if rounds is None else rounds - 1
        if rounds == 0 or not new.filter("old <> comp").take(1):
            return labels


def link_texts(docs: DataFrame, sign: Callable, shingle: int, percent: int, rows: int, lower: bool, id_col: str, text_col: str):
    """(classes with their component, signatures, verified links between classes)."""
    sigs = stored(signatures(docs, sign, shingle, rows, lower, id_col, text_col))
    some = sigs.filter("n > 0 and id is not null")
    classes = stored(some.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("p").alias("p"))
                     .select("id", "k1", "k2", "n", "bands", *[F.col("p")[i].alias(f"p{i}") for i in range(SKETCH_WORDS)]))
    facts = F.struct("id", "k1", "k2", "n", *[f"p{i}" for i in range(SKETCH_WORDS)])
    differ = " + ".join(f"bit_count(a.p{i} ^ b.p{i})" for i in range(SKETCH_WORDS))
    # |A n B| / |A u B| >= t means that the sets differ in at most (1 - t) / (1 + t) of |A| + |B| shingles.
    likely = F.expr(f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) and {100 + percent} * ({differ}) <= {100 - percent} * (a.n + b.n)")

    def with_facts(pairs: DataFrame) -> DataFrame:
        """(x, y, a, b) of pairs of ids."""
        return (pairs.join(classes.select(F.col("id").alias("x"), facts.alias("a")), "x")
                .join(classes.select(F.col("id").alias("y"), facts.alias("b")), "y"))

    # Members against the smallest of each bucket.
    banded = classes.select(F.explode("bands").alias("h"), "id")
    centers = stored(banded.groupBy("h").agg(F.min("id").alias("x"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
    pairs = banded.join(centers, "h").filter("id <> x").select("x", F.col("id").alias("y")).distinct()
    first = stored(with_facts(pairs).filter(likely))
    wanted = first.select("a.id", "a.k1", "a.k2").union(first.select("b.id", "b.k1", "b.k2")).distinct()
    sets = class_sets(wanted, docs, shingle, lower, id_col, text_col)
    links = verified(first, sets, percent)
    comp = components(links, rounds=2)  # labels inside a component may still differ: more is compared, nothing missed
    # Strays against the other members of their buckets.
    labelled = classes.join(comp, "id", "left").select(F.explode("bands").alias("h"), "id", F.coalesce("comp", "id").alias("comp"))
    members = stored(labelled.join(centers.select("h"), "h"))
    parts = members.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = stored(parts.groupBy("h").agg(F.max(F.struct("c", "comp")).alias("most"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", F.col("most.comp").alias("main")))
    members = stored(members.join(mixed, "h"))
    full = members.join(classes.select("id", F.col("n"), *[f"p{i}" for i in range(SKETCH_WORDS)]), "id")
    side = F.struct("id", "comp", "n", *[f"p{i}" for i in range(SKETCH_WORDS)])
    stray = full.filter("comp <> main").select("h", side.alias("a"))
    pairs = stray.join(full.select("h", side.alias("b")), "h").filter(F.expr("a.comp <> b.comp") & likely)
    pairs = pairs.select(F.least("a.id", "b.id").alias("x"), F.greatest("a.id", "b.id").alias("y")).distinct()
    second = stored(with_facts(pairs.join(first.select("x", "y"), ["x", "y"], "left_anti")))
    if second.take(1):
        more = second.select("a.id", "a.k1", "a.k2").union(second.select("b.id", "b.k1", "b.k2")).distinct()
        sets = sets.unionByName(class_sets(more.join(wanted, ["id", "k1", "k2"], "left_anti"), docs, shingle, lower, id_col, text_col))
        links = stored(links.union(verified(second, sets, percent)))
    comp = components(links)
    classes = classes.join(comp, "id", "left").select("k1", "k2", F.coalesce("comp", "id").alias("comp"))
    return classes, sigs, links
