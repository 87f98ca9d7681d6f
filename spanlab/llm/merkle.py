"""Merkle manifest of a dataset: a hash tree over every document, by group, with proofs.

A leaf is the digest of a row's named columns.  Inside a group (language) the leaves are in ascending id order; the
groups' roots, in order of the group, form a tree of their own.  While several nodes remain, every two consecutive
ones (the last run: fewer, even one) become the digest of their concatenated hex digests.

Leaf coordinates come from bitmaps: each task sends the ids it has seen as compressed containers (65,536 ids of one
group: a sorted list or a bitmap, zstandard), the containers of a group are merged, and their popcounts are added up to a
directory.  A row's coordinate is then a rank query: the directory entry of its 64-id word plus the popcount of the
word's lower bits.  Documents are not sorted; only the containers are (one row per 65,536 ids).  ``2 ** block_bits``
consecutive nodes, keyed by group and block, then fill a slot array in which the levels of the block are reduced at
once; the blocks' tops are the nodes of the next round.

Defined results: nulls are leaves' parts of their own (``-``); the null group is first; rows without an id come
first in their group; rows that share an id (or have none) are ordered among themselves by their leaf, equal rows
being interchangeable; an empty table has no rows, no subroots and no root.  Ids are integers (64 bits).  Columns that
are not hashed take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, ranked, stored

HASHED = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 12
#: Rows a task gathers before it sends their containers.
GATHER = 1 << 18
#: Container of the rows without an id: in front of those of all 64-bit ids.
_NO_ID = -(1 << 47) - 1


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex sha256 of the concatenated values, each ``-`` if null, else byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- containers ------------------------------------------------------------------------------------------------

def pack(low: np.ndarray) -> bytes:
    """Compressed container of sorted distinct 16-bit numbers: a list where it is shorter, else a bitmap."""
    if len(low) < 4096:
        raw = b"l" + low.astype("<u2").tobytes()
    else:
        bits = np.zeros(65536, np.uint8)
        bits[low] = 1
        raw = b"b" + np.packbits(bits, bitorder="little").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    if raw[:1] == b"l":
        return np.frombuffer(raw, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=1), bitorder="little"))


def _containers(rows: DataFrame) -> DataFrame:
    """(g, hi, n, bitmap, repeated, extra): one row for each group and 65,536 ids; ``n`` counts rows, ``repeated`` lists
    ids of several rows and ``extra`` how many more each has."""
    def partial(batches):
        def send(held):
            t = pa.Table.from_batches(held).combine_chunks()
            code = t.column("g").chunk(0).dictionary_encode()
            g, names = code.indices.to_numpy(), code.dictionary.to_pylist()
            hi, lo = t.column("hi").to_numpy(), t.column("lo").to_numpy()
            order = np.lexsort((lo, hi, g))
            g, hi, lo = g[order], hi[order], lo[order]
            cut = np.flatnonzero((np.diff(g) != 0) | (np.diff(hi) != 0)) + 1
            out = []
            for a, b in zip([0, *cut], [*cut, len(g)]):
                ids, n = np.unique(lo[a:b], return_counts=True)
                out.append((names[g[a]], int(hi[a]), pack(ids), ids[n > 1].astype("<u2").tobytes(), (n[n > 1] - 1).astype("<i8").tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                              names=["g", "hi", "bitmap", "repeated", "extra"])
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= GATHER:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    def merge(t: pa.Table) -> pa.Table:
        n = np.zeros(65536, np.int64)
        for bitmap, rep, more in zip(*(t.column(c) for c in ("bitmap", "repeated", "extra"))):
            n[unpack(bitmap.as_py())] += 1
            n[np.frombuffer(rep.as_py(), "<u2")] += np.frombuffer(more.as_py(), "<i8")
        rep = np.flatnonzero(n > 1)
        row = (t.column("g")[0].as_py(), t.column("hi")[0].as_py(), int(n.sum()), pack(np.flatnonzero(n)), rep.astype(np.int32), n[rep] - 1)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=["g", "hi", "n", "bitmap", "repeated", "extra"])

    parts = rows.select("g", "hi", "lo").mapInArrow(partial, "g string, hi long, bitmap binary, repeated binary, extra binary")
    return parts.groupBy("g", "hi").applyInArrow(merge, "g string, hi long, n long, bitmap binary, repeated array<int>, extra array<long>")


def _directory(containers: DataFrame) -> DataFrame:
    """Containers with ``base`` (rows of the group in earlier ones) and ``total`` (rows of the group): running sums
    inside range partitions plus the sums of earlier partitions (one row each)."""
    s = stored(containers.orderBy("g", "hi").withColumn("__m", F.monotonically_increasing_id()))
    s = s.withColumn("__p", F.shiftright("__m", 33))
    earlier = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = s.groupBy("__p").agg(F.sum("n").alias("__n")).select("__p", earlier.alias("__o"))
    inside = Window.partitionBy("__p").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    pos = stored(s.withColumn("__i", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(offsets), "__p")
                 .withColumn("__pos", F.col("__o") + F.col("__i")).drop("__m", "__p", "__o", "__i"))
    groups = pos.groupBy("g").agg(F.min("__pos").alias("__first"), F.sum("n").alias("total"))
    return pos.join(groups, "g").withColumn("base", F.col("__pos") - F.col("__first")).drop("__pos", "__first")


def _words(directory: DataFrame) -> DataFrame:
    """(g, hi, w, bits, below, total, repeats): a row for each 64-id word that holds an id; ``below`` rows of the group
    are in earlier words."""
    def run(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("g", "hi", "base", "total", "bitmap", "repeated", "extra")]
            for g, hi, base, total, bitmap, rep, more in zip(*cols):
                n = np.zeros(65536, np.int64)
                n[unpack(bitmap)] = 1
                bits = np.packbits((n > 0).reshape(1024, 64), axis=1, bitorder="little").reshape(-1).view("<i8")
                n[rep] += np.array(more, np.int64)
                sums = n.reshape(1024, 64).sum(1)
                below = base + np.cumsum(sums) - sums
                lists = [[] for _ in range(1024)]
                for r, m in zip(rep, more):
                    lists[r >> 6].append({"bit": r & 63, "more": m})
                at = np.flatnonzero(sums)
                k = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * k), pa.array(np.full(k, hi)), pa.array(at.astype(np.int32)), pa.array(bits[at]), pa.array(below[at]),
                     pa.array(np.full(k, total)), pa.array([lists[i] for i in at], pa.list_(pa.struct([("bit", pa.int32()), ("more", pa.int64())])))],
                    names=["g", "hi", "w", "bits", "below", "total", "repeats"])

    return directory.select("g", "hi", "base", "total", "bitmap", "repeated", "extra").mapInArrow(
        run, "g string, hi long, w int, bits long, below long, total long, repeats array<struct<bit int, more long>>")


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` (g, id, leaf and others) with ``idx``, the 0-based position of each in its group, and ``total``."""
    hi = F.coalesce(F.shiftright("id", 16), F.lit(_NO_ID))
    lo = F.coalesce(F.col("id").bitwiseAND(F.lit(65535)), F.lit(0)).cast("int")
    keyed = rows.withColumn("hi", hi).withColumn("lo", lo)
    containers = stored(_containers(keyed))
    words = _words(_directory(containers))
    bit = F.col("lo").bitwiseAND(F.lit(63))
    lower = F.when(bit == 0, F.lit(0)).otherwise(F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(64) - bit))
    more = F.aggregate(F.filter("repeats", lambda r: r["bit"] < bit), F.lit(0).cast("long"), lambda a, r: a + r["more"])
    found = (keyed.withColumn("w", F.shiftright("lo", 6)).join(words, ["g", "hi", "w"])
             .withColumn("idx", F.col("below") + F.bit_count(F.col("bits").bitwiseAND(lower)) + more)
             .withColumn("__tie", F.exists("repeats", lambda r: r["bit"] == bit)).select(*rows.columns, "idx", "total", "__tie"))
    if not containers.filter(F.size("repeated") > 0).take(1):
        return found.drop("__tie")
    found = stored(found)
    tied = stored(ranked(found.filter("__tie"), [F.col("g"), F.col("id").asc_nulls_first(), F.col("leaf")], "__r"))
    first = tied.groupBy("g", "idx").agg(F.min("__r").alias("__first"))  # rows of one id have one idx so far
    tied = tied.join(first, ["g", "idx"]).withColumn("idx", F.col("idx") + F.col("__r") - F.col("__first"))
    return found.filter(~F.col("__tie")).drop("__tie").unionByName(tied.select(*rows.columns, "idx", "total"))


# --- levels ----------------------------------------------------------------------------------------------------

def _levels(nodes: list[str], bits: int, whole: bool) -> list[list[str]]:
    """The levels over a block's slot array: ``bits`` of them, or up to the root where the block is the whole tree."""
    out = [nodes]
    for _ in range(bits):
        d = out[-1]
        if whole and len(d) == 1:
            break
        out.append([_h(d[i] + d[i + 1]) if i + 1 < len(d) else _h(d[i]) for i in range(0, len(d), 2)])
    return out


def _slots(t: pa.Table, bits: int) -> tuple[np.ndarray, list[str], bool]:
    """Slot of each row, the digests by slot, and whether the block is the whole tree."""
    slot = t.column("idx").to_numpy() & ((1 << bits) - 1)
    nodes = np.empty(len(slot), object)
    nodes[slot] = t.column("digest").to_pylist()
    return slot, nodes.tolist(), t.column("total")[0].as_py() <= 1 << bits


def _climb(nodes: DataFrame, bits: int) -> DataFrame:
    """(g, idx, digest, total, done): the top of every block, a node of the next round or (``done``) a root."""
    def run(t: pa.Table) -> pa.Table:
        _, d, whole = _slots(t, bits)
        total = t.column("total")[0].as_py()
        return pa.table({"g": pa.array([t.column("g")[0].as_py()], pa.string()), "idx": [t.column("idx")[0].as_py() >> bits],
                         "digest": [_levels(d, bits, whole)[-1][0]], "total": [-(-total // (1 << bits))], "done": [whole]})

    keyed = nodes.select("g", "idx", "digest", "total", F.shiftright("idx", bits).alias("block"))
    return keyed.groupBy("g", "block").applyInArrow(run, "g string, idx long, digest string, total long, done boolean")


def _descend(nodes: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """Columns of ``nodes`` and ``path``: the steps from each node to the root, given the blocks' own (g, idx, path).
    A step is ``l`` or ``r`` and the sibling on that side, or ``-`` where a node is alone in its run."""
    names = [c for c in nodes.columns]

    def run(t: pa.Table, up: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return pa.table({**{c: t.column(c) for c in names}, "path": pa.array([], pa.list_(pa.string()))})
        slot, d, whole = _slots(t, bits)
        upper = up.column("path")[0].as_py()
        levels = _levels(d, bits, whole)
        levels = levels[:-1] if len(levels) > 1 else []
        steps = [[("r" + x[i + 1] if i + 1 < len(x) else "-") if i % 2 == 0 else "l" + x[i - 1] for i in range(len(x))] for x in levels]
        paths = [[s[i >> k] for k, s in enumerate(steps)] + upper for i in slot.tolist()]
        return pa.table({**{c: t.column(c) for c in names}, "path": pa.array(paths, pa.list_(pa.string()))})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    left = nodes.withColumn("block", F.shiftright("idx", bits)).groupBy("g", "block")
    right = above.select("g", F.col("idx").alias("block"), "path").groupBy("g", "block")
    return left.cogroup(right).applyInArrow(run, f"{kinds}, path array<string>")


@dataclass
class Tree:
    """Rounds of nodes (g, idx, digest, total, ...) of one tree per group, and their roots (g, digest)."""
    rounds: list[DataFrame]
    roots: DataFrame
    bits: int
    ends: list[DataFrame]

    @classmethod
    def reduce(cls, nodes: DataFrame, bits: int) -> Tree:
        rounds, ends = [nodes], []
        while True:
            tops = stored(_climb(rounds[-1], bits))
            ends.append(tops.filter("done"))
            rest = tops.filter("NOT done").drop("done")
            if not rest.take(1):
                break
            rounds.append(rest)
        roots = ends[0]
        for e in ends[1:]:
            roots = roots.unionByName(e)
        return cls(rounds, roots.select("g", "digest"), bits, ends)

    def paths(self, above: DataFrame) -> DataFrame:
        """The first round's rows with their ``path``; ``above`` (g, path): the steps from each group's root on."""
        up = None
        for nodes, end in zip(reversed(self.rounds), reversed(self.ends)):
            own = end.select("g", "idx").join(above, "g")
            up = _descend(nodes, own if up is None else own.unionByName(up.select("g", "idx", "path")), self.bits)
        return up


@dataclass
class Manifest:
    leaves: Tree
    groups: Tree
    subroots: DataFrame  # (g, subroot), g as in ``group_key``

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", hashed: Sequence[str] = HASHED,
              carry: Mapping[str, Column] | None = None, block_bits: int = BLOCK_BITS) -> Manifest:
        """The manifest of ``docs``; ``carry`` names further columns that ``proofs`` returns."""
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("g"),
                           leaf_digest([F.col(c) for c in hashed]).alias("leaf"), *[c.alias(k) for k, c in (carry or {}).items()])
        placed = stored(coordinates(stored(rows)).withColumnRenamed("leaf", "digest"))
        leaves = Tree.reduce(placed, block_bits)
        subroots = stored(leaves.roots.withColumnRenamed("digest", "subroot"))
        order = stored(ranked(subroots, [F.col("g")], "idx"))  # '-' (null) sorts before '=...'
        n = order.count()
        top = order.select(F.lit("").alias("g"), F.col("idx").cast("long").alias("idx"), F.col("subroot").alias("digest"), F.lit(n).cast("long").alias("total"),
                           F.col("g").alias("of"))
        return cls(leaves, Tree.reduce(top, block_bits), subroots)

    def root(self) -> str | None:
        r = self.groups.roots.first()
        return r["digest"] if r else None

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, path, carried columns): ``path`` leads from the leaf through the subroot to the root."""
        start = self.groups.roots.select("g", F.array().cast("array<string>").alias("path"))
        above = stored(self.groups.paths(start).select(F.col("of").alias("g"), "path"))
        return self.leaves.paths(above).join(self.subroots, "g").withColumnRenamed("digest", "leaf").drop("g", "idx", "total")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    def step(acc, s):
        other = F.substring(s, 2, 64)
        return F.sha2(F.when(s == "-", acc).when(s.startswith("l"), F.concat(other, acc)).otherwise(F.concat(acc, other)), 256)
    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """Digest of a path's siblings, in order from the leaf up."""
    return F.sha2(F.array_join(F.transform(F.filter(path, lambda s: s != "-"), lambda s: F.substring(s, 2, 64)), ""), 256)


def checked(manifest: Manifest, claim: Column | None = None) -> DataFrame:
    """``proofs`` with ``root``, ``proof_sha256``, ``folded_root`` (from the leaf ``claim``; the row's own by default) and
    ``verified``."""
    root = F.lit(manifest.root()).cast("string")
    out = manifest.proofs().withColumn("root", root).withColumn("proof_sha256", proof_digest(F.col("path")))
    return out.withColumn("folded_root", fold(F.col("leaf") if claim is None else claim, F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    tampered = [F.when(struck, F.try_add(F.col(c).cast("long"), F.lit(1))).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in HASHED]
    # null where the document is as it was: the leaf is claimed then
    m = Manifest.build(docs, carry={"claimed": F.when(struck, leaf_digest(tampered))})
    return checked(m, F.coalesce("claimed", "leaf")).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
