"""Language identification by error-correcting output codes.

Every language has a codeword; each bit is predicted by a binary classifier over hashed byte n-grams, the log odds of
an n-gram under the languages whose bit is 1 against those whose bit is 0.  A text's margins (mean log odds, scaled by
the bit's expected margin) are decoded by loss: the language whose codeword has the least exponential loss, summed
with the bits' weights, is chosen.  A text is flagged as ambiguous when its second-nearest codeword is nearly as near.

Training is one pass over all labelled rows: counts of n-grams by language are summed in each task and then by Spark;
what reaches the driver is ``BUCKETS`` counts for each language, whatever the input's size.

Defined results: ``und`` with score 0 for null text, for text without a letter, and where nothing was learned; a
model of one language always answers it with score 1; other columns are left out of predictions.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, chunks, free, random_words, text_bytes

BUCKETS = 1 << 15
N = 3
#: Up to so many languages the code has every split of them as a bit; beyond, random splits.
EXHAUSTIVE = 6
#: Second-best codewords within this much of the best probability make a text ambiguous.
AMBIGUOUS = 0.02
UND = "und"

_LETTER = regex.compile(r"\p{L}")
# Letters in lower case, other ASCII as a space, bytes of other characters as they are.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_GRAM = random_words(31, 3 * 256).reshape(3, 256)


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every byte, and whether it counts: inside one text and not only spaces."""
    n = len(data)
    if n < N:
        return np.zeros(n, np.int64), np.zeros(n, bool)
    b = _FOLD[data]
    h = _GRAM[0][b].copy()
    for j in range(1, N):
        h[:n - j] ^= _GRAM[j][b[j:]]
    ok = b != 32
    some = ok.copy()
    for j in range(1, N):
        some[:n - j] |= ok[j:]
        ends = off[1:] - j  # the last bytes of a text start no n-gram
        some[ends[(ends >= off[:-1])]] = False
    some[n - N + 1:] = False
    return (h >> np.uint64(64 - 15)).astype(np.int64) % BUCKETS, some


def code_matrix(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:
        cols = [(1, *c) for c in product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(cols, np.int8).T
    bits, best, far = int(np.ceil(10 * np.log2(n))), None, -1
    for seed in range(50):
        m = np.where(np.random.default_rng(seed).random((n, bits)) < 0.5, -1, 1).astype(np.int8)
        if (np.abs(m.sum(0)) == n).any():
            continue
        agree = m.astype(int) @ m.T
        near = bits - max(agree[i, j] for i in range(n) for j in range(i))
        if near > far:
            best, far = m, near
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray     # languages x bits
    weights: np.ndarray  # buckets x bits: scaled log odds
    bit_weight: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language with the least loss, its share of probability, and whether it is ambiguous."""
        m = np.clip(margins, -4, 4)
        loss = np.exp(-m[:, None, :] * self.code[None]) @ self.bit_weight
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        top = p[np.arange(len(p)), best]
        if p.shape[1] < 2:
            return best, top, np.zeros(len(p), bool)
        second = np.partition(p, -2, axis=1)[:, -2]
        return best, top, top - second < AMBIGUOUS


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> LanguageModel:
    """Train on all rows of ``labelled`` that have a text and a language."""
    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch, "text"):
                data, off = text_bytes(part.column("text"))
                g, ok = _grams(data, off)
                names = part.column("lang").to_pylist()
                for k, name in enumerate(names):
                    a, b = off[k], off[k + 1]
                    if name not in total:
                        total[name] = np.zeros(BUCKETS, np.int64)
                    total[name] += np.bincount(g[a:b][ok[a:b]], minlength=BUCKETS) if b - a > BUCKETS else 0
                    if b - a <= BUCKETS:
                        np.add.at(total[name], g[a:b][ok[a:b]], 1)
        for name, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "g": pa.array(at, pa.int32()), "n": pa.array(t[at], pa.int64())})

    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    got = rows.mapInArrow(count, "lang string, g int, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(got["lang"].unique())
    n = np.zeros((len(languages), BUCKETS))
    if len(got):
        n[np.searchsorted(languages, got["lang"]), got["g"]] = got["n"]
    p = (n + smoothing) / (n + smoothing).sum(1, keepdims=True) if len(languages) else n
    code = code_matrix(len(languages))
    w = np.zeros((BUCKETS, code.shape[1]), np.float32)
    trust = np.ones(code.shape[1])
    if len(languages) > 1:
        for b in range(code.shape[1]):
            one, zero = code[:, b] > 0, code[:, b] < 0
            odds = np.log(p[one].mean(0)) - np.log(p[zero].mean(0))
            margin = (p @ odds) * code[:, b]  # expected margin of each language's own n-grams
            least = max(float(margin.min()), 1e-3)
            w[:, b] = odds * (2.0 / least)
            trust[b] = least
    return LanguageModel(languages, code, w, trust / trust.mean())


def predict(docs: DataFrame, model: LanguageModel, id_cols: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``id_cols`` (all but the text where None) and lang_pred, score, ambiguous as the last three columns (with an
    underscore added where ``id_cols`` has the name)."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # languages' codewords and BUCKETS x bits weights
    keep = [c for c in docs.columns if c != text_col] if id_cols is None else id_cols
    source = text_col if text_col in keep else "__text"
    names = [*keep, *(free(c, keep) for c in ("lang_pred", "score", "ambiguous"))]

    def run(batches):
        m = held.value
        bits = m.weights.shape[1]
        for batch in batches:
            for part in chunks(batch, source, max(1 << 14, CHUNK_BYTES * 8 // max(8, bits))):
                texts = part.column(source).to_pylist()
                data, off = text_bytes(part.column(source))
                lang = np.full(len(texts), UND, object)
                score, unsure = np.zeros(len(texts)), np.zeros(len(texts), bool)
                lettered = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
                if len(m.languages) == 1:
                    lang[lettered], score[lettered] = m.languages[0], 1.0
                elif m.languages and lettered.any():
                    g, ok = _grams(data, off)
                    sums = np.empty((len(texts), bits))
                    for b in range(bits):  # sums of weights between the texts' offsets
                        c = np.concatenate([[0.0], np.cumsum(np.where(ok, m.weights[:, b][g], np.float32(0)), dtype=np.float64)])
                        sums[:, b] = c[off[1:]] - c[off[:-1]]
                    seen = np.concatenate([[0], np.cumsum(ok)])
                    seen = np.maximum(1, seen[off[1:]] - seen[off[:-1]])
                    best, top, close = m.decode(sums / seen[:, None])
                    for k in np.flatnonzero(lettered):
                        lang[k], score[k], unsure[k] = m.languages[best[k]], top[k], close[k]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure)],
                                                 names=names)

    sel = docs.select(*keep, *([] if text_col in keep else [F.col(text_col).alias("__text")]))
    schema = T.StructType([*[sel.schema[c] for c in keep], *(T.StructField(c, t) for c, t in zip(names[-3:], (T.StringType(), T.DoubleType(), T.BooleanType())))])
    return sel.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def query(spark, sf_dir):
    from .common import documents
    docs = documents(spark, sf_dir)
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, model)
