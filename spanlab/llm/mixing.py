"""Mixing sources to target weights.

Every document gets a hash-random key.  Inside its source the documents are ordered by that key, token counts are
summed along the order, and the source is cut exactly at its budget: whole epochs first, then the documents in front
of the cut, the one on the cut in part.  The order is split into ``BUCKETS`` key ranges per source, so the prefix
sums are a window over one range plus the offset of the range (a window over at most ``BUCKETS`` rows per source): a
source with a third of all rows spreads over as many tasks as any other set of ranges.

Defined results: null text has size 0; a null source is a source of its own, ordered last; equal keys (repeated
rows) are ordered by size and are interchangeable; a source of size 0 has target 0; an empty table gives no rows.
Columns other than those named are left out of ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, ranked, stored

WEIGHTS = (5.0, 2.0, 1.0)  # by source in code point order, repeating
CAP = 3.0  # a source is read at most so many times
#: Hex digits of the key that name a range: 16**3 ranges per source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words (runs of characters other than space and 0x09-0x0D); 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(per: DataFrame, weights=WEIGHTS, cap: float = CAP, share: float = 1.0) -> DataFrame:
    """``per``: (source, source_size).  Adds ``target``: ``share`` of all sizes dealt out by weight, no source above
    ``cap`` times its size, the excess dealt out again by weight among the others until none is above."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__r") % len(weights) + 1).cast("int"))
    per = stored(ranked(per, [F.col("source").asc_nulls_last()], "__r").withColumn("__w", w))
    most = cap * F.col("source_size")
    total, all_w = per.agg(F.sum("source_size"), F.sum("__w")).first()
    if not total:
        return per.select("source", "source_size", F.lit(0.0).alias("target"))
    level = share * total / all_w
    while True:  # the level only rises and only sources at their cap change it, so this ends
        above = F.col("__w") * level > most
        capped, free_w = per.agg(F.sum(F.when(above, most).otherwise(0.0)), F.sum(F.when(~above, F.col("__w")).otherwise(0.0))).first()
        new = (share * total - capped) / free_w if free_w else level
        if new <= level:
            break
        level = new
    return per.select("source", "source_size", F.round(F.least(F.col("__w") * level, most), 6).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0,
        weights=WEIGHTS, cap: float = CAP, share: float = 1.0, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, columns of ``keep``): ``taken`` words of each document by an exact cut at the
    source's budget, ``copies`` whole documents (the one on the cut counts if at least half of it is inside)."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))))
    sizes = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               word_count(F.col(text_col)).alias("size"), key.alias("__k"), *keep)
                   .withColumn("__s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
                   .withColumn("__b", F.substring("__k", 1, RANGE_DIGITS)))
    ranges = stored(sizes.groupBy("source", "__s", "__b").agg(F.sum("size").alias("__n")))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("__n").alias("source_size")), weights, cap, share)
    targets = targets.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("__s"), "source_size", "target")
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranges.select("__s", "__b", before.alias("__o")).join(targets, "__s")
    inside = Window.partitionBy("__s", "__b").orderBy("__k", "size", *keep).rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("__i", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0)).cast("long")
    left = F.greatest(F.lit(0), budget - F.col("__e") * F.col("source_size") - F.col("__o") - F.col("__i"))
    return (rows.join(offsets, ["__s", "__b"])
            .withColumn("__e", epochs)
            .withColumn("__p", F.least(F.col("size"), left).cast("long"))
            .select("doc_id", "size", "source_size", "target", (F.col("__e") * F.col("size") + F.col("__p")).alias("taken"),
                    (F.col("__e") + F.when((F.col("size") > 0) & (2 * F.col("__p") >= F.col("size")), 1).otherwise(0)).alias("copies"), *keep))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The documents of the mix with all their columns: a row for each whole copy that the mix takes.  Rows are
    joined back by a stored number, so repeated and null ids count as any other."""
    rows, row = numbered(docs)
    taken = mix(rows, id_col, keep=[row], **params).filter("copies > 0").select(F.col(row).alias("__d"), F.col("copies").alias("__c"))
    return (rows.join(taken, F.col(row) == F.col("__d"))
            .withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("__c").cast("int")))).select(*docs.columns))


ORACLE = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM p),
o AS (SELECT *, coalesce(sum(3.0::DOUBLE * source_size) OVER q, 0) AS capped, coalesce(sum(w) OVER q, 0) AS wc,
  sum(source_size) OVER () AS total, sum(w) OVER () AS ws FROM r
  WINDOW q AS (ORDER BY 3.0::DOUBLE * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT max((total - capped) / (ws - wc)) FILTER (w * (total - capped) / (ws - wc) <= 3.0::DOUBLE * source_size) AS lam FROM o),
t AS (SELECT source, source_size, round(least(w * (SELECT lam FROM v), 3.0::DOUBLE * source_size), 6) AS target FROM r),
k AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
  CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('0:' || d.doc_id), d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + least(size, greatest(0, budget % source_size - pos)) END AS BIGINT) AS taken
FROM k
"""


def query(spark, sf_dir):
    from .common import documents
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
