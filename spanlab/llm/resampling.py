"""Importance resampling towards a target distribution.

A pre-tokenizer of the ``tokenizers`` library (an untrained ``Split`` on a regular expression, over text whose A-Z are
lower-cased) gives the words of a text with their offsets.  Windows over the offset pairs, from the first word's start
to the last word's end, are the features: runs of ``low`` to ``high`` consecutive words, joined by one space.  A
feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.  The histograms of the raw and of the target texts
give each bucket a gain (log likelihood ratio with add-one smoothing, in whole thousandths), a document's weight is the
sum of its features' gains, and the draw without replacement takes the largest scores (weight plus a Gumbel number that
depends on the seed and the id only).

Work: one pass over the texts, which leaves each document's distinct buckets with their counts as a stored table; the
histograms and the weights read that table.  A task sends one row for each bucket to the sum, and what reaches the driver
is ``buckets`` rows a table, whatever the input's size.  Ranks come from a range sort and one offset a partition.

Defined results: null and empty texts have no features, weight 0 and a score of their Gumbel number; a null id counts
as the empty string in the Gumbel number and is last among equal scores; repeated rows are ranked as rows of their own
(equal ones are interchangeable); an empty target or raw table leaves a histogram of zeros; an empty table gives no
rows.  Texts are read whole, in pieces cut between words.  Columns other than those named are left out of ``resample``
and kept by ``drawn``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, documents, numbered, ranked, stored

#: A run of characters other than ASCII without digits and small letters (the text's A-Z are small by then).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: Characters given to the pre-tokenizer at once, and remembered features of a worker.
PIECE, MEMO = 1 << 15, 1 << 18


@dataclass(frozen=True)
class Spec:
    """Features: runs of ``low`` to ``high`` words in ``buckets`` buckets."""
    low: int = 1
    high: int = 1
    buckets: int = BUCKETS
    pattern: str = WORD


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about ``PIECE`` characters, cut in front of a space or line feed."""
    lo, n = 0, len(text)
    while n - lo > PIECE:
        cuts = [c for c in (text.find(" ", lo + PIECE), text.find("\n", lo + PIECE)) if c >= 0]
        if not cuts:
            break
        yield text[lo:min(cuts)]
        lo = min(cuts)
    yield text[lo:]


class Reader:
    """Words and bucket counts of one text after the other (one reader a task)."""

    def __init__(self, spec: Spec):
        from tokenizers import Regex, pre_tokenizers
        self.spec, self.memo = spec, {}
        self.split = pre_tokenizers.Split(Regex(spec.pattern), "removed", invert=True)

    def _bucket(self, feature: str) -> int:
        b = self.memo.get(feature)
        if b is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            b = self.memo[feature] = zlib.crc32(feature.encode()) % self.spec.buckets
        return b

    def read(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words and the bucket of every feature of a lower-cased text."""
        s, n, out, tail = self.spec, 0, [], []
        for piece in _pieces(text):
            spans = [span for _, span in self.split.pre_tokenize_str(piece)]
            n += len(spans)
            if s.high == 1:
                out += [self._bucket(piece[a:b]) for a, b in spans]
                continue
            words = tail + [piece[a:b] for a, b in spans]
            for k in range(s.low, s.high + 1):
                first = max(0, len(tail) - k + 1)  # windows that end in this piece
                out += [self._bucket(" ".join(words[i:i + k])) for i in range(first, len(words) - k + 1)]
            tail = words[-(s.high - 1):]
        return n, np.array(out, np.int32)


def feature_counts(rows: DataFrame, text_col: str, spec: Spec, keep: Sequence[str] = ()) -> DataFrame:
    """(columns of ``keep``, n_words, n_features, buckets, counts): a row for each row."""
    if not 1 <= spec.low <= spec.high:
        raise ValueError("feature runs: 1 <= low <= high")
    sel = rows.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([*[sel.schema[c] for c in keep], T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                           T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def run(batches):
        reader = Reader(spec)
        for whole in batches:
            for b in chunks(whole, "__text"):
                low = pc.ascii_lower(b.column("__text").fill_null("")).to_pylist()
                words, n, bs, cs, off = [], [], [], [], [0]
                for text in low:
                    w, f = reader.read(text)
                    u, c = np.unique(f, return_counts=True)
                    words.append(w), n.append(len(f)), bs.append(u), cs.append(c), off.append(off[-1] + len(u))
                offs = pa.array(off, pa.int32())
                lists = [pa.ListArray.from_arrays(offs, pa.array(np.concatenate(x).astype(np.int32))) for x in (bs, cs)]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(words, pa.int64()), pa.array(n, pa.int64()), *lists],
                                                 names=[*keep, "n_words", "n_features", "buckets", "counts"])

    return sel.mapInArrow(run, schema)


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, counts and the row of each."""
    bk, ct = b.column("buckets"), b.column("counts")
    sizes = pc.list_value_length(bk).to_numpy(zero_copy_only=False).astype(np.int64)
    return bk.flatten().to_numpy(), ct.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def histogram(feats: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows of ``feature_counts``: one row a bucket and task, summed by Spark."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            bk, ct, _ = _flat(b)
            np.add.at(total, bk, ct)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "n"])

    out = np.zeros(buckets, np.int64)
    for r in feats.select("buckets", "counts").mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log likelihood ratio of each bucket with add-one smoothing, in whole thousandths (floor)."""
    k = len(raw)
    s_all, t_all = float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + k) / ((float(s) + 1) * (t_all + k))))
                     for s, t in zip(raw, target)], np.int64)


def weighted(feats: DataFrame, gain: np.ndarray, keep: Sequence[str] = ()) -> DataFrame:
    """(columns of ``keep``, n_words, n_features, weight): the sum of gains over each row's features."""
    schema = T.StructType([*[feats.schema[c] for c in [*keep, "n_words", "n_features"]], T.StructField("weight", T.LongType())])

    def run(batches):
        for b in batches:
            bk, ct, row = _flat(b)
            w = np.zeros(b.num_rows, np.int64)
            np.add.at(w, row, gain[bk] * ct)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in [*keep, "n_words", "n_features"]], pa.array(w)], names=schema.names)

    return feats.mapInArrow(run, schema)


def gumbel(id_col: Column, seed: int) -> Column:
    """floor(1000 * Gumbel number) of a seed and an id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = 10,
             min_words: int = 20, seed: int = 2024, spec: Spec = Spec(), keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, columns of ``keep``) of every document; ``rank`` is null where the
    draw of ``percent`` of the documents with ``min_words`` words or more does not take it."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__t"), *keep)
    feats = stored(feature_counts(rows, "__t", spec, ["doc_id", *keep]))
    gain = gains(histogram(feats, spec.buckets), histogram(feature_counts(target, target_text, spec), spec.buckets))
    scored = weighted(feats, gain, ["doc_id", *keep]).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    long_enough = F.col("n_words") >= min_words
    draw = percent * feats.filter(long_enough).count() // 100
    order = ranked(scored.withColumn("__in", long_enough), [F.col("__in").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "__r")
    taken = F.when(F.col("__in") & (F.col("__r") < draw), F.col("__r") + 1).cast("long")
    return order.select("doc_id", "n_features", "weight", "score", taken.alias("rank"), *keep)


def drawn(docs: DataFrame, target: DataFrame, **params) -> DataFrame:
    """The drawn documents with all their columns (joined back by a stored row number)."""
    rows, row = numbered(docs)
    take = resample(rows, target, keep=[row], **params).filter("rank IS NOT NULL").select(F.col(row).alias("__d"))
    return rows.join(take, F.col(row) == F.col("__d")).select(*docs.columns)


def query(spark, sf_dir):
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
