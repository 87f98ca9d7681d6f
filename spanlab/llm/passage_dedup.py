"""Repeated passages by merging Burrows-Wheeler transforms.

A byte is removed when a string of ``LENGTH`` bytes that covers it starts at another place of the corpus, too.

1. *Anchors.*  In every window of ``LENGTH`` bytes the ``ANCHOR``-byte substring of least hash (the leftmost of equals)
   is the window's anchor; equal windows have equal anchors, and about one place in 130 is one.  Windows whose anchor
   occurs once cannot repeat.
2. *Contexts.*  The windows of an anchor occurrence are consecutive; the bytes they span are its context.  Equal
   contexts are counted together before anything is compared, so a passage copied a million times is one context of
   multiplicity a million.  Contexts go to buckets by anchor.
3. *Transforms.*  A bucket's contexts are dealt to shards.  A context is read as interleaved texts of ``GRAM``-byte
   symbols (one text for each residue), so a string of ``LENGTH`` bytes is ``LENGTH / GRAM`` symbols of one text.  Each
   shard sorts its own suffixes and keeps their transform: the symbol in front of each suffix, in suffix order.
4. *Merge.*  The shards' transforms are merged by refining an interleave vector (which shard holds the next suffix):
   round k sorts the vector stably by the symbols in front, which makes it right for prefixes of k symbols.  Suffixes
   are not sorted again.  Common prefixes come with it: neighbours that part in round k share k - 1 symbols, and after
   ``LENGTH / GRAM`` rounds the undivided intervals are the strings of ``LENGTH`` bytes.  An interval of total
   multiplicity two or more repeats.  A second hash over whole windows guards against colliding symbol names.

An anchor with one distinct context needs no merge: its windows occur as often as the context.  An anchor with more than ``HEAVY`` different contexts would fill a bucket alone; its windows are counted one by one by a
128-bit hash over all tasks instead, which gives the same answer.

Defined results: null text counts as empty; texts shorter than ``LENGTH`` lose nothing; rows are judged one by one,
also where ids are null or repeat; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, CHUNK_BYTES, chunks, mix64, random_words, stored, text_bytes

LENGTH = 400
ANCHOR = 128
GRAM = 50
BUCKET_BYTES = 512 << 10   # contexts of a bucket, on average
SHARD_BYTES = 128 << 10    # contexts of a shard
MIN_BUCKETS = 256
HEAVY = 1_000              # contexts of one anchor that fill a bucket alone (672 bytes each at most)
_NONE = ~np.uint64(0)


# --- hashes of all substrings of one length ---

_tables: dict[int, list[np.ndarray]] = {}


def _gram_hashes(data: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of ``data[i:i + k]`` for every i."""
    n = len(data)
    if n < k:
        return np.zeros(0, np.uint64)
    base = (_BASE + 2 * int(random_words(70 + seed, 1)[0])) % 2**64 | 1
    if seed not in _tables or len(_tables[seed][1]) < n + 1:
        size = 1 << max(20, (n + 1).bit_length())
        up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)
        while len(up) < size:
            m = len(up)
            up = np.concatenate([up, up * np.uint64(pow(base, m, 2**64))])
            down = np.concatenate([down, down * np.uint64(pow(pow(base, -1, 2**64), m, 2**64))])
        _tables[seed] = [random_words(71 + seed, 256), up, down]
    byte, up, down = _tables[seed]
    c = np.empty(n + 1, np.uint64)
    c[0] = 0
    np.cumsum(byte[data] * up[:n], out=c[1:])
    return mix64((c[k:] - c[:-k]) * down[:n - k + 1])


def _argmin_windows(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the least value (leftmost of equals) in every window of ``w`` values: running minima of blocks from
    both sides."""
    n = len(h)
    rows = -(-n // w)
    x = np.full(rows * w, _NONE)
    x[:n] = h
    x = x.reshape(rows, w)
    at = np.arange(rows * w).reshape(rows, w)
    pre = np.minimum.accumulate(x, 1)
    new = np.ones(x.shape, bool)
    new[:, 1:] = x[:, 1:] < pre[:, :-1]
    pre_at = np.maximum.accumulate(np.where(new, at, 0), 1).ravel()
    back = x[:, ::-1]
    suf = np.minimum.accumulate(back, 1)
    new[:, 1:] = back[:, 1:] <= suf[:, :-1]
    suf_at = np.minimum.accumulate(np.where(new, at[:, ::-1], rows * w), 1)[:, ::-1].ravel()
    pre, suf = pre.ravel(), suf[:, ::-1].ravel()
    m = n - w + 1
    return np.where(suf[:m] <= pre[w - 1:w - 1 + m], suf_at[:m], pre_at[w - 1:w - 1 + m])


def anchors(data: np.ndarray, off: np.ndarray, length: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the hashes of its anchors in order and the first window of each."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int32))
    if len(data) < length:
        return [none] * (len(off) - 1)
    h = _gram_hashes(data, k)
    place = _argmin_windows(h, length - k + 1)
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        if b - a < length:
            out.append(none)
            continue
        p = place[a:b - length + 1]
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        out.append((h[p[first]].view(np.int64), first.astype(np.int32)))
    return out


# --- transforms of a bucket ---

class Contexts:
    """Contexts of a bucket as interleaved texts of symbols."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        if length % gram:
            raise ValueError("the length must be a multiple of the symbol width")
        self.length, self.gram, self.rounds = length, gram, length // gram
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(t) for t in texts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.many = self.size - gram + 1                      # symbols of a context
        self.first = np.concatenate([[0], np.cumsum(self.many)])
        if self.begin[-1] >= 1 << 31:
            raise ValueError("too many bytes for one bucket")
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), self.many)
        self.at = (np.arange(self.first[-1]) - np.repeat(self.first[:-1], self.many)).astype(np.int32)  # place in the context
        hashes = _gram_hashes(self.data, gram)[np.repeat(self.begin[:-1], self.many) + self.at]
        order = np.argsort(hashes)
        hashes = hashes[order]
        self.name = np.empty(len(order), np.int32)            # from 1; 0 ends a text
        self.name[order] = np.cumsum(np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(order)], dtype=np.int32)

    def shard(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Transform of contexts lo to hi - 1: the symbols in front of the suffixes in suffix order, and the place of
        each suffix (-1: the end of a text; ends come first)."""
        a, b = self.first[lo], self.first[hi]
        name, at, left = self.name[a:b], self.at[a:b], (self.many[self.owner[a:b]] - self.at[a:b])
        rank, step, n = name, self.gram, 1
        while n < self.rounds:  # suffixes by 2, 4, 8 ... symbols
            pair = rank.astype(np.int64) * (int(rank.max(initial=0)) + 1)
            has = np.flatnonzero(left > step)
            pair[has] += rank[has + step]
            order = np.argsort(pair)
            pair = pair[order]
            rank = np.empty(len(order), np.int32)
            rank[order] = np.cumsum(np.concatenate([[True], pair[1:] != pair[:-1]])[:len(order)], dtype=np.int32)
            step, n = 2 * step, 2 * n
        order = np.argsort(rank, kind="stable")
        front = np.zeros(len(name), np.int32)
        inner = np.flatnonzero(at >= self.gram)
        front[inner] = name[inner - self.gram]
        ends = np.flatnonzero(left <= self.gram)              # last symbol of every text
        return np.concatenate([name[ends], front[order]]), np.concatenate([np.full(len(ends), -1), a + order]).astype(np.int32)


def _stable_order(x: np.ndarray) -> np.ndarray:
    """Stable sort order of non-negative integers below 2**32, by radix passes of 16 bits."""
    order = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    if len(x) and int(x.max()) > 0xFFFF:
        order = order[np.argsort((x >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def merge_transforms(shards: list[tuple[np.ndarray, np.ndarray]], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms.  Returns the place of every suffix in merged order and its common prefix with the suffix before
    it (in symbols, at most ``rounds``)."""
    front = np.concatenate([s[0] for s in shards])
    place = np.concatenate([s[1] for s in shards])
    z = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(s[0]) for s in shards])  # the interleave
    n = len(z)
    block = np.zeros(n, np.int32)
    lcp = np.full(n, rounds, np.int16)
    nth = np.arange(n, dtype=np.int32)  # of each merged suffix, its index in the shards' own order
    for k in range(rounds):
        symbol = front[nth]
        order = _stable_order(symbol)
        z, symbol, old = z[order], symbol[order], block[order]
        parts = np.ones(n, bool)
        parts[1:] = (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])
        lcp[parts & (lcp == rounds)] = k
        block = np.cumsum(parts, dtype=np.int32) - 1
        nth[np.argsort(z, kind="stable")] = np.arange(n, dtype=np.int32)
    return place[nth], lcp


def repeated_windows(texts: list[bytes], times: np.ndarray, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """Per context which of its windows occur twice or more, contexts counting ``times`` each."""
    c = Contexts(texts, length, gram)
    shard_of = (c.begin[:-1] // shard_bytes)
    if len(np.unique(shard_of)) > 1 << 16:
        raise ValueError("too many shards for one bucket")
    cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], shard_of[1:] != shard_of[:-1]])), [len(texts)]])
    place, lcp = merge_transforms([c.shard(a, b) for a, b in zip(cuts[:-1], cuts[1:])], c.rounds)
    block = np.cumsum(lcp < c.rounds)  # intervals of equal prefixes of the whole length
    start = np.flatnonzero(place >= 0)
    place, block = place[start], block[start]
    whole = np.flatnonzero(c.at[place] <= c.size[c.owner[place]] - length)
    place, block = place[whole], block[whole]
    byte = c.begin[c.owner[place]] + c.at[place]
    guard = _gram_hashes(c.data, length, seed=1)[byte]
    if len(block) and ((block[1:] == block[:-1]) & (guard[1:] != guard[:-1])).any():  # colliding names: part them
        order = np.lexsort((guard, block))
        place, block, guard = place[order], block[order], guard[order]
        block = np.cumsum(np.concatenate([[True], (block[1:] != block[:-1]) | (guard[1:] != guard[:-1])]))
    total = np.bincount(block, weights=times[c.owner[place]]) if len(block) else np.zeros(0)
    hit = np.zeros(len(c.owner), bool)
    hit[place[total[block] >= 2]] = True
    return [hit[a:a + s - length + 1] for a, s in zip(c.first, c.size)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    d = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


# --- Spark ---

def _prepared(docs: DataFrame, id_col: str, text_col: str, length: int, anchor: int) -> DataFrame:
    """A row for each document: compressed bytes, their number and digest, anchors and first windows."""
    sel = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = sel.schema["doc_id"].dataType.simpleString()

    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                data, off = text_bytes(part.column("text"))
                got = anchors(data, off, length, anchor)
                raw = [data[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([
                    part.column("rid"), part.column("doc_id"), pa.array(np.diff(off)), pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                    pa.array([z.compress(r) for r in raw], pa.binary()), pa.array([h for h, _ in got], pa.list_(pa.int64())), pa.array([w for _, w in got], pa.list_(pa.int32()))],
                    names=["rid", "doc_id", "n_bytes", "sha", "z", "h", "w"])
    return stored(sel.mapInArrow(run, f"rid long, doc_id {kind}, n_bytes long, sha string, z binary, h array<long>, w array<int>"))


def _contexts(docs: DataFrame, prepared: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(members, distinct contexts): (h, cid, rid, lo) for every occurrence of a repeated anchor, and (h, cid, n, ctx)."""
    each = prepared.select("rid", "n_bytes", F.explode(F.arrays_zip("h", "w", F.expr("slice(w, 2, size(w))").alias("next"))).alias("x"))
    each = each.select("rid", F.col("x.h").alias("h"), F.col("x.w").alias("lo"), F.coalesce(F.col("x.next"), (F.col("n_bytes") - length + 1).cast("int")).alias("hi"))
    # a table of its own, so that both sides of the join are shuffled for it and a hot anchor's rows can be split
    often = stored(each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h"))
    cand = each.join(often, "h").groupBy("rid").agg(F.collect_list(F.struct("h", "lo", "hi")).alias("c"))
    texts = prepared.select("rid", "z").join(cand, "rid")

    def run(batches):
        z = zstandard.ZstdDecompressor()
        seen: set = set()
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                out: dict[str, list] = {"h": [], "cid": [], "rid": [], "lo": [], "ctx": []}
                for rid, data, cs in zip(part.column("rid").to_pylist(), part.column("z").to_pylist(), part.column("c").to_pylist()):
                    data = z.decompress(data)
                    for x in cs:
                        ctx = data[x["lo"]:x["hi"] + length - 1]
                        cid = xxhash.xxh3_64_intdigest(ctx) - 2**63
                        out["h"].append(x["h"])
                        out["cid"].append(cid)
                        out["rid"].append(rid)
                        out["lo"].append(x["lo"])
                        key = (x["h"], cid)
                        out["ctx"].append(None if key in seen else ctx)  # once per task is enough
                        seen.add(key)
                if len(seen) > 500_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(out["h"], pa.int64()), pa.array(out["cid"], pa.int64()), pa.array(out["rid"], pa.int64()),
                                                  pa.array(out["lo"], pa.int32()), pa.array(out["ctx"], pa.binary())], names=list(out))

    rows = stored(texts.mapInArrow(run, "h long, cid long, rid long, lo int, ctx binary"))
    count = rows.groupBy("h", "cid").agg(F.count(F.lit(1)).alias("n"))
    first = rows.filter("ctx is not null").select("h", "cid", "ctx").dropDuplicates(["h", "cid"])
    return rows.select("h", "cid", "rid", "lo"), stored(first.join(count, ["h", "cid"]))


def _repeats(distinct: DataFrame, length: int, heavy: int) -> DataFrame:
    """(h, cid, start, stop): runs of repeated windows of every distinct context, counted from its first."""
    # an anchor with one distinct context occurs twice or more inside equal bytes: all its windows repeat
    load = stored(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.sum(F.length("ctx")).alias("size"), F.first("cid").alias("cid")))
    size = load.filter("c > 1").agg(F.sum("size")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-size // BUCKET_BYTES))
    schema = "h long, cid long, start array<int>, stop array<int>"
    alone = load.filter("c = 1").select("h", "cid", F.array(F.lit(0)).alias("start"), F.array((F.col("size") - (length - 1)).cast("int")).alias("stop"))
    crowded = load.filter(F.col("c") > heavy).select("h")
    usual = distinct.join(load.filter((F.col("c") > 1) & (F.col("c") <= heavy)).select("h"), "h").withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))

    def merge(t: pa.Table) -> pa.Table:
        hits = repeated_windows(t.column("ctx").to_pylist(), np.asarray(t.column("n")), length)
        got = [runs(m) for m in hits]
        keep = [i for i, g in enumerate(got) if len(g[0])]
        return pa.table({"h": t.column("h").take(pa.array(keep, pa.int64())), "cid": t.column("cid").take(pa.array(keep, pa.int64())),
                         "start": pa.array([got[i][0].astype(np.int32) for i in keep], pa.list_(pa.int32())),
                         "stop": pa.array([got[i][1].astype(np.int32) for i in keep], pa.list_(pa.int32()))})

    out = alone.unionByName(usual.groupBy("bucket").applyInArrow(merge, schema))
    if not crowded.take(1):
        return out

    def windows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                h, cid, n, ctx = (batch.column(c)[k].as_py() for c in ("h", "cid", "n", "ctx"))
                data = np.frombuffer(ctx, np.uint8)
                a, b = _gram_hashes(data, length), _gram_hashes(data, length, seed=1)
                m = len(a)
                yield pa.RecordBatch.from_arrays([pa.array([h] * m, pa.int64()), pa.array([cid] * m, pa.int64()), pa.array([n] * m, pa.int64()),
                                                  pa.array(np.arange(m), pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                 names=["h", "cid", "n", "at", "a", "b"])

    w = distinct.join(crowded, "h").select("h", "cid", "n", "ctx").mapInArrow(windows, "h long, cid long, n long, at int, a long, b long")
    twice = w.groupBy("a", "b").agg(F.sum("n").alias("t")).filter("t > 1").select("a", "b")
    single = w.join(twice, ["a", "b"]).groupBy("h", "cid").agg(F.sort_array(F.collect_list("at")).alias("start"))
    return out.unionByName(single.withColumn("stop", F.transform("start", lambda x: x + 1)).select("h", "cid", "start", "stop"))


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, heavy: int = HEAVY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, sha, z, at): every row with its compressed bytes and ``at``, the runs of window starts whose
    strings repeat (array of start and stop; null: none)."""
    prepared = _prepared(docs, id_col, text_col, length, anchor)
    members, distinct = _contexts(docs, prepared, length)
    found = stored(_repeats(distinct, length, heavy))
    hit = members.join(found, ["h", "cid"]).select("rid", F.transform(F.arrays_zip("start", "stop"), lambda x: F.struct((x["start"] + F.col("lo")).alias("start"), (x["stop"] + F.col("lo")).alias("stop"))).alias("r"))
    per = hit.groupBy("rid").agg(F.flatten(F.collect_list("r")).alias("at"))
    return prepared.select("rid", "doc_id", "n_bytes", "sha", "z").join(per, "rid", "left").drop("rid")


def _covered(n: int, at, length: int) -> np.ndarray:
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, [x["start"] for x in at], 1)
    np.add.at(d, [x["stop"] + length - 1 for x in at], -1)
    return np.cumsum(d[:n]) > 0


def without_repeats(docs: DataFrame, length: int = LENGTH, digest: bool = False, **params) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary, spans): the remaining bytes of every row and the removed
    runs as array<struct<start, stop>>; ``digest``: kept_sha256 in place of both."""
    found = repeats(docs, length, **params)
    kind = found.schema["doc_id"].dataType.simpleString()
    tail = "kept_sha256 string" if digest else "kept binary, spans array<struct<start:long,stop:long>>"

    def run(batches):
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                removed, n_spans, sha, kept, spans = [], [], [], [], []
                for n, s, data, at in zip(*(part.column(c).to_pylist() for c in ("n_bytes", "sha", "z", "at"))):
                    gone = _covered(n, at, length) if at else np.zeros(0, bool)
                    a, b = runs(gone)
                    removed.append(int(gone.sum()))
                    n_spans.append(len(a))
                    if at or not digest:
                        data = np.frombuffer(z.decompress(data), np.uint8)
                        left = data[~gone].tobytes() if at else data.tobytes()
                        s = hashlib.sha256(left).hexdigest()
                        kept.append(left)
                    sha.append(s)
                    spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(a, b)])
                last = [pa.array(sha, pa.string())] if digest else [pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), *last],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", *(["kept_sha256"] if digest else ["kept", "spans"])])

    return found.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {tail}")


def query(spark, sf_dir):
    from .common import documents
    return without_repeats(documents(spark, sf_dir), digest=True)
