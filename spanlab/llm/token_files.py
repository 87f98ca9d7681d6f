"""Token ids in bit-plane files.

A file holds blocks of ``BLOCK`` ids (the last may be shorter).  A block of 32-bit ids is transposed into 4 byte
planes or 32 bit planes, each plane is compressed with zstandard (an all-zero plane takes no bytes), and the chunk
index at the end of the file has the place, id count, plane lengths and crc32 of every block, so any range of ids can
be read alone::

    b"BPZ1" | planes of block 0 | planes of block 1 | ... | documents | index | footer

``documents`` are the ids and token counts of the documents, ``index`` is JSON, both compressed with zstandard; the
footer is their two lengths and the magic again.  Files are written by Spark tasks into the shared folder under names
of their own; a file counts only if the manifest names it, and the manifest is written by Spark from the tasks that
succeeded, so retried and lost tasks leave no doubles.

Defined results: null text counts as empty (its end id only); a null id sorts first; rows of equal id are ordered by
text; an empty table gives a manifest without rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _TABLES, GOLDEN, _power_tables, chunks, mix64, scratch, stored, text_bytes

BLOCK = 1 << 16
MAGIC = b"BPZ1"
LEVEL = 3
#: Units of text whose ids a worker remembers (speed only).
MEMO = 500_000


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if m := re.match(r"file:/+", uri):
        return pafs.LocalFileSystem(), "/" + uri[m.end():]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), os.path.abspath(uri))


# --- format ---

def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte (4) or bit (32) planes of uint32 ids."""
    m = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(m[:, k]).tobytes() for k in range(4)]
    b = np.unpackbits(m, axis=1, bitorder="little")
    return [np.packbits(b[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        m = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            if p:
                m[:, k] = np.frombuffer(p, np.uint8)
    else:
        b = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            if p:
                b[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
        m = np.packbits(b, axis=1, bitorder="little")
    return m.view("<u4").ravel()


class PlaneWriter:
    """Writes one file as ids arrive; keeps one block and the token counts in memory."""

    def __init__(self, uri: str, bits: bool = False):
        fs, path = _open_fs(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.bits = fs.open_output_stream(path), bits
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.blocks: list[list] = []
        self.held, self.n_held, self.at, self.total = [], 0, 0, 0
        self.doc_ids, self.counts = [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= BLOCK:
            have = np.frombuffer(b"".join(self.held), "<u4")
            full = len(have) // BLOCK * BLOCK
            for lo in range(0, full, BLOCK):
                self._block(have[lo:lo + BLOCK])
            self.held, self.n_held = [have[full:].tobytes()], len(have) - full

    def _block(self, ids: np.ndarray) -> None:
        at, sizes = self.at, []
        for p in to_planes(ids, self.bits):
            sizes.append(self._put(self.zip.compress(p)) if p.strip(b"\0") else 0)
        self.blocks.append([at, len(ids), zlib.crc32(ids.tobytes()), sizes])
        self.total += len(ids)

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.held), "<u4")
        if len(rest):
            self._block(rest)
        docs = struct.pack("<Q", len(self.counts)) + np.array(self.counts, "<i8").tobytes()
        docs += np.array([d is not None for d in self.doc_ids], np.uint8).tobytes()
        docs += np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        a = self._put(self.zip.compress(docs))
        b = self._put(self.zip.compress(json.dumps({"block": BLOCK, "planes": 32 if self.bits else 4, "ids": self.total, "blocks": self.blocks}).encode()))
        self._put(struct.pack("<QQ", a, b) + MAGIC)
        self.out.close()


class PlaneReader:
    """Random access to the blocks of one file."""

    def __init__(self, uri: str):
        fs, path = _open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(20, size - 20)
        if tail[16:] != MAGIC or self.file.read_at(4, 0) != MAGIC:
            raise ValueError(f"{uri}: not a whole bit-plane file")
        a, b = struct.unpack("<QQ", tail[:16])
        self.unzip = zstandard.ZstdDecompressor()
        docs = self.unzip.decompress(self.file.read_at(a, size - 20 - b - a))
        self.index = json.loads(self.unzip.decompress(self.file.read_at(b, size - 20 - b)))
        n = struct.unpack("<Q", docs[:8])[0]
        self.counts = np.frombuffer(docs, "<i8", n, 8)
        there = np.frombuffer(docs, np.uint8, n, 8 + 8 * n)
        ids = np.frombuffer(docs, "<i8", n, 8 + 9 * n)
        self.doc_ids = pa.array(ids, pa.int64(), mask=there == 0)

    def block(self, k: int) -> np.ndarray:
        at, n, crc, sizes = self.index["blocks"][k]
        planes = []
        for s in sizes:
            planes.append(self.unzip.decompress(self.file.read_at(s, at)) if s else b"")
            at += s
        ids = from_planes(planes, n)
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError("a block's ids do not match its checksum")
        return ids

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file; only the blocks that hold them are read."""
        size = self.index["block"]
        got = [self.block(k) for k in range(start // size, -(-(start + n) // size))] if n else []
        return np.concatenate(got)[start % size:start % size + n] if got else np.zeros(0, np.uint32)

    def documents(self):
        """(row, ids as bytes) in file order, a block in memory at a time besides the document."""
        held, k = b"", 0
        for row, n in enumerate(self.counts.tolist()):
            parts, have = [held], len(held)
            while have < 4 * n:
                parts.append(self.block(k).tobytes())
                have += len(parts[-1])
                k += 1
            data = b"".join(parts) if len(parts) > 1 else held
            yield row, data[:4 * n]
            held = data[4 * n:]


# --- tokenizer ---

# Bytes by what they can be split at.  Pieces lie between spaces and line breaks (0); inside one, runs of letters and
# bytes of other characters (1), single digits (2) and runs of punctuation (3) are units of their own.  A piece with a
# byte of kind 4 is one unit: control characters, an apostrophe (contractions), "<" (special tokens begin with it),
# and first bytes of blocks with many characters that are no letters (speed only, see ``Tokens``).
_KIND = np.full(256, 4, np.uint8)
_KIND[[0x20, 0x0A]] = 0
_KIND[0x21:0x7F] = 3
_KIND[ord("a"):ord("z") + 1] = _KIND[ord("A"):ord("Z") + 1] = 1
_KIND[0x80:] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[[ord("'"), ord("<"), 0xC2, 0xCC, 0xCD, 0xE2, *range(0xF0, 0x100)]] = 4
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_WHOLE = np.uint64(0x5851F42D4C957F2D)  # keeps whole pieces apart from units of the same bytes


class Tokens:
    """Ids of texts by the tokenizers library, remembered for each unit of text.

    The tokenizer drops white space, never joins across it, lower-cases, takes runs of letters, single digits and runs of
    other characters.  Units are found and named (64-bit hashes) for a whole batch at once; only units not seen before
    go through the library, the ids of all are gathered by offsets.  A character that is not plainly a letter in the
    tokenizer's own tables and normal form (asked once for each) makes its whole piece a unit."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.plain: dict[str, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[int, int] = {}  # hash of a unit -> its slot; -1: not a unit, its piece is
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count, self.hits = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.n = 0

    def _letters(self, text: str) -> bool:
        """Whether the tokenizer takes every character as a letter, apart from punctuation on either side."""
        for c in set(text).difference(self.plain):
            near = self.tok.normalizer.normalize_str(f".{c}.")
            got = [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(near)]
            self.plain[c] = len(got) == 3 and got[0] == got[2] == "."
        return all(map(self.plain.__getitem__, text))

    def _remember(self, keys: list[int], units: list[str]) -> None:
        for lo in range(0, len(units), 4096):
            part = self.tok.encode_batch_fast(units[lo:lo + 4096], add_special_tokens=False)
            ids = [e.ids for e in part]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for e in ids for i in e), np.uint32, int(sizes.sum()))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            while self.n + len(ids) > len(self.first):
                self.first, self.count, self.hits = (np.concatenate([v, np.zeros_like(v)]) for v in (self.first, self.count, self.hits))
            self.pool[self.used:self.used + len(flat)] = flat
            at = slice(self.n, self.n + len(ids))
            self.first[at], self.count[at], self.hits[at] = self.used + np.cumsum(sizes) - sizes, sizes, 0
            self.slot.update(zip(keys[lo:lo + 4096], range(self.n, self.n + len(ids))))
            self.used += len(flat)
            self.n += len(ids)

    def _forget(self) -> None:
        """Keep the half of the memory that most batches used."""
        keep = np.sort(np.argsort(-self.hits[:self.n], kind="stable")[:MEMO // 2])
        new = np.full(self.n, -2)
        new[keep] = np.arange(len(keep))
        ids = [self.pool[a:a + c] for a, c in zip(self.first[keep].tolist(), self.count[keep].tolist())]
        old = self.slot
        hits, count = self.hits[keep] // 2, self.count[keep]
        self._reset()
        self.slot = {k: int(new[v]) for k, v in old.items() if v >= 0 and new[v] >= 0}
        size = 1 << max(16, len(keep).bit_length())
        self.first, self.count, self.hits = (np.zeros(size, np.int64) for _ in range(3))
        self.n, self.pool = len(keep), np.concatenate([*ids, np.zeros(1 << 16, np.uint32)])
        self.used = int(count.sum())
        self.first[:self.n], self.count[:self.n], self.hits[:self.n] = np.cumsum(count) - count, count, hits

    def batch(self, texts: list[str | None]) -> list[bytes]:
        return self.encode(pa.array(texts, pa.string()))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        data, off = text_bytes(texts)
        n = len(data)
        if n == 0:
            return [b""] * (len(off) - 1)
        if len(self.slot) > MEMO:
            self._forget()
        kind = _KIND[data]
        inner = kind > 0
        begins = np.zeros(n + 1, bool)
        begins[off] = True  # a text begins, or the last has ended
        before = np.concatenate([[False], inner[:-1]])
        after = np.concatenate([inner[1:], [False]])
        start, end = np.flatnonzero(inner & (~before | begins[:n])), np.flatnonzero(inner & (~after | begins[1:])) + 1
        odd = np.concatenate([[0], np.cumsum(kind == 4, dtype=np.int32)])
        whole = odd[end] > odd[start]
        while True:
            step = np.zeros(n + 1, np.int8)
            step[start[whole]] += 1
            step[end[whole]] -= 1
            inside = np.cumsum(step[:n], dtype=np.int8).view(bool)
            opens = inner & ~inside
            opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
            opens[start] = True
            a = np.flatnonzero(opens)
            piece = np.searchsorted(start, a, "right") - 1
            z = np.minimum(np.append(a[1:], n), end[piece])
            byte = np.where(inside, data, _LOW[data])
            up, down = _power_tables(n)
            total = np.empty(n + 1, np.uint64)
            total[0] = 0
            np.cumsum(_TABLES[False][byte] * up[:n], out=total[1:])
            h = mix64((total[z] - total[a]) * down[a] + (z - a).astype(np.uint64) * GOLDEN)
            h[whole[piece]] ^= _WHOLE
            names, index, inverse = np.unique(h, return_index=True, return_inverse=True)
            keys = names.tolist()
            slots = list(map(self.slot.get, keys))
            new = [i for i, v in enumerate(slots) if v is None]
            if new:
                at = index[new]
                raw = byte.tobytes()
                texts_ = [raw[x:y].decode() for x, y in zip(a[at].tolist(), z[at].tolist())]
                kept, units = [], []
                for i, t, w in zip(new, texts_, whole[piece[at]].tolist()):
                    if w or t.isascii() or self._letters(t):
                        kept.append(keys[i])
                        units.append(t)
                    else:
                        self.slot[keys[i]] = -1
                self._remember(kept, units)
                for i in new:
                    slots[i] = self.slot[keys[i]]
            slots = np.array(slots, np.int64)
            bad = slots < 0
            if not bad.any():
                break
            whole[piece[bad[inverse]]] = True  # at most once: whole pieces are always units
        self.hits[slots] += 1
        count = self.count[slots][inverse]
        ends = np.cumsum(count)
        ids = self.pool[np.repeat(self.first[slots][inverse] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)].astype("<u4")
        cut = np.concatenate([[0], ends])[np.searchsorted(a, off)]
        return [ids[x:y].tobytes() for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


# --- Spark ---

def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id",
                      text_col: str = "text", bits: bool = False) -> DataFrame:
    """Write the ids of all texts in ascending id order, one file for each range of ids.  Returns the manifest:
    (file, path, start, n_docs, n_ids), ``start`` = ids in all earlier files; also stored as ``folder``/manifest."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        pid, w, path = TaskContext.get().partitionId(), None, ""
        enc = tokens(tokenizer)
        for b in batches:
            for part in chunks(b, "text"):
                if w is None:
                    path = f"{folder}/ids-{pid:06d}-{uuid.uuid4().hex}.bpz"
                    w = PlaneWriter(path, bits)
                for d, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1))):
                    w.add(d, ids + end)
        if w is not None:
            w.close()
            yield pa.RecordBatch.from_pydict({"file": pa.array([pid], pa.int32()), "path": [path], "n_docs": [len(w.counts)], "n_ids": [w.total]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    files = (rows.repartitionByRange("id").sortWithinPartitions("id", "text")
             .mapInArrow(run, "file int, path string, n_docs long, n_ids long"))
    files = stored(files)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.select("file", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"), "n_docs", "n_ids")
    files.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(files.schema).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """Documents of the files: (doc_id, start, n_tokens, ids array<int>), or ids_crc32 in place of the ids."""
    kind = "ids_crc32 long" if digest else "ids array<int>"

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = PlaneReader(path)
                ends = np.cumsum(f.counts) + start
                held, lo = [], 0
                for row, ids in f.documents():
                    held.append(zlib.crc32(ids) if digest else np.frombuffer(ids, "<u4").astype(np.int32))
                    if len(held) == 1024 or row + 1 == len(f.counts):
                        hi = row + 1
                        yield pa.RecordBatch.from_arrays([
                            f.doc_ids.slice(lo, hi - lo), pa.array(ends[lo:hi] - f.counts[lo:hi], pa.int64()),
                            pa.array(f.counts[lo:hi], pa.int64()), pa.array(held, pa.int64() if digest else pa.list_(pa.int32()))],
                            names=["doc_id", "start", "n_tokens", kind.split()[0]])
                        held, lo = [], hi

    spread = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(run, f"doc_id long, start long, n_tokens long, {kind}")


def query(spark, sf_dir):
    import public_tokenizers

    from .common import documents
    manifest = write_token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2, scratch(spark))
    return read_token_files(manifest, digest=True)
