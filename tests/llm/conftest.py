import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# Names that operators use inside.
CLASHES = ["size", "n_words", "found", "_t", "_w", "spans", "r", "set", "key", "a", "b", "d", "h", "k", "u", "v", "n", "label", "score", "_found", "_next", "text_", "host", "lines", "target", "_q", "_s", "_d", "_h", "_host", "_over", "_base", "kept"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text, lang, source; the last two may be left out) as a documents table."""
    def make(rows, clash=False):
        full = [(*r, *("en", "s0")[len(r) - 2:], len(r[1]) if r[1] is not None else None) for r in map(tuple, rows)]
        df = spark.createDataFrame(full, DOCS)
        return df.withColumns({c: F.lit("x") for c in CLASHES}) if clash else df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i}x{i % 13}" for i in range(30_000))
    return [(None, None, None, None), (None, "one two three", "en", None), (1, "", "en", "s0"), (2, None, "de", "s1"), (3, long, "en", "s0"), (3, long, "en", "s0"),
            (4, "   \n\t ", None, "s1"), (5, "short text", "en", "s0"), (5, "other text with the same id", "fr", None), (6, "Short Text", "en", "s0"),
            (7, "a " * 500, "en", "s2"), (8, "déjà vu élève    été \U0001f600", "fr", "s2")]


@pytest.fixture(scope="session")
def sf001_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
