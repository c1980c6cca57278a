"""Small hand-made document tables for the training-data operators."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs(spark):
    """texts -> documents; items are texts or (doc_id, text[, source])."""
    def make(rows, schema=DOCS):
        out = []
        for i, r in enumerate(rows):
            doc, text, *source = r if isinstance(r, tuple) else (i, r)
            out.append((doc, text, "en", source[0] if source else f"src{i % 3}", None if text is None else len(text)))
        return spark.createDataFrame(out, schema).coalesce(2)
    return make


#: names that operators use inside, given to columns they must leave alone
CLASHING = ["id", "key", "node", "size", "a", "b", "line", "line_no", "removed", "rank", "rate", "cap", "n", "u", "v", "digest",
            "tokens", "row", "t", "maybe", "their", "part", "weight", "score", "toxic", "toxicity", "gone", "piece", "host", "path"]


@pytest.fixture()
def clash():
    """Add columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING if c not in df.columns})
    return add
