"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text worked on at once inside a task (one longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and read it again: later steps neither recompute it nor depend
    on the executors that made it."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores added while ``taken`` has it in any case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """A stored copy with a number for each row, and the name of that column."""
    row = free("__row", df.columns)
    return stored(df.withColumn(row, F.monotonically_increasing_id())), row


def ranked(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """0-based position of each row in a total order, without a single-partition window: range sort, position
    inside the partition, plus the number of rows in earlier partitions (one row per partition)."""
    s = stored(df.orderBy(*order).withColumn("__m", F.monotonically_increasing_id()))
    s = s.withColumn("__p", F.shiftright("__m", 33))
    per = s.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("__p", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__o"))
    return (s.join(F.broadcast(offs), "__p")
            .withColumn(out, F.col("__o") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__m", "__p", "__o"))


# --- numpy over Arrow text -------------------------------------------------------------------------------------

def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offset of each text in them; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text each, at least one row."""
    if batch.num_rows == 0:
        return
    _, off = text_bytes(batch.column(column))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer over uint64 (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def random_words(seed: int, n: int, odd: bool = False) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 values of a seed."""
    x = mix64(np.arange(1, n + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed * int(_M2) % 2**64))
    return x | np.uint64(1) if odd else x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0xD6E8FEB86659FD93  # odd: invertible modulo 2**64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64, by doubling."""
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        t = _powers[k]
        while len(t) <= n:
            t = np.concatenate([t, t * np.uint64(pow(base, len(t), 1 << 64))])
        _powers[k] = t
    return _powers[0], _powers[1]


def _byte_table(lower: bool) -> np.ndarray:
    t = random_words(11, 256)
    if lower:
        t[65:91] = t[97:123]
    return t


_TABLES = {b: _byte_table(b) for b in (False, True)}


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (maximal run of bytes other than space and 0x09-0x0D) and the number of the
    first word of each text (one more entry than texts).  ``lower``: A-Z count as a-z."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)  # a text begins here
    cut[off] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    start = np.flatnonzero(word & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    end = np.flatnonzero(word & (~after | cut[1:])) + 1
    up, down = _power_tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_TABLES[lower][data] * up[:n], out=total[1:])
    h = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * GOLDEN)
    return h, np.searchsorted(start, off, "left")


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int, lower: bool) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word ``k``-shingles.  A text of fewer words has its
    whole sequence as one shingle; a text without words has none."""
    h, first = word_hashes(data, off, lower)
    coef = random_words(23, k, odd=True)
    n = len(h)
    full = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        full += h[j:j + len(full)] * coef[j]
    full = mix64(full)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            out.append(np.unique(full[a:b - k + 1]))
        elif b > a:
            length = np.array([b - a], np.uint64) * GOLDEN
            out.append(mix64((h[a:b] * coef[:b - a]).sum(keepdims=True, dtype=np.uint64) + length))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def hex_sha256(data: bytes) -> str:
    import hashlib
    return hashlib.sha256(data).hexdigest()
