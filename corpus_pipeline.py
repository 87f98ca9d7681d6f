"""A corpus pipeline of five training-data operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before it; ``run`` writes every stage's rows
as Parquet in the shared checkpoint folder and reads them again.  Null texts and empty tables go through every stage:
a document without letters is rejected by the first, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlab.llm import language_id, line_dedup, mixing, near_dedup, piece_codec
from spanlab.llm.common import documents, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model tells: those without a letter and those flagged as ambiguous go.  Where no
    row has a language to learn from, all documents stay."""
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    told = language_id.predict(docs, model, id_cols=docs.columns)
    pred, _, ambiguous = told.columns[-3:]
    return told.filter((F.col(pred) != language_id.UND) & ~F.col(ambiguous)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that are in five documents or more, save in the largest id."""
    out = line_dedup.LineIndex.build(docs).clean(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(out.columns[-1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, once for each copy it takes."""
    return mixing.mixed_documents(docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded text."""
    return piece_codec.round_trip(docs, piece_codec.model_path())


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", piece_stage),
]

#: SQL has neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
