import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang, source]) tuples, with extra columns whose names operators use inside."""
    def build(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        if extra:
            for c in ("id", "h", "n", "key", "size", "rid", "score", "ambiguous", "n_lines", "n_dropped", "kept", "spans", "value", "comp"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and blank texts, repeated rows and ids, a very long text."""
    long = " ".join(f"word{i % 997} other{i % 31}" for i in range(40_000))
    return make([(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one two three"), (4, "one two three"), (4, "another text with the same id"),
                 (None, "no id but some words here and there"), (None, None), (5, long, "en", "a"), (6, long, "en", None), (7, "\n\n\n"), (8, "é漢😀 ▁ \x00")])


def docs_of(sf=SF):
    import duckdb
    return duckdb.sql(f"select doc_id, text, lang, source from '{sf}/documents.parquet' order by doc_id").fetchall()
