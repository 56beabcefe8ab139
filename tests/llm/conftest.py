import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty and very long texts, ties, repeated rows, null ids, and columns that clash with results."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away from it all day long"),
        (1, "the quick brown fox jumps over the lazy dog and runs away from it all day long"),
        (2, "the quick brown fox jumps over the lazy dog and runs away from it all day long"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, LONG),
        (7, "one"),
        (None, "no id here but some words"),
        (None, None),
        (8, "Ünïcode ÄÖÜ 漢字 😀 mixed spaces here"),
        (9, "x" * 50_000),
    ]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit("clash") for c in ("score", "predicted", "held_out", "ids", "fp", "digest", "component_id", "n_tokens", "_id", "_digest", "_many", "_doc", "label", "decoded", "word", "copies")}
    return df.withColumns(clash)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
