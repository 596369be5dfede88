"""Frames with everything an operator must cope with."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    long_text = " ".join(f"w{k % 977}" for k in range(30_000))
    rows = [(1, "a plain text of some words", "en", "s1", 5), (1, "a plain text of some words", "en", "s1", 5),
            (2, "a plain text of some words", "en", None, None), (3, None, None, None, None), (4, "", "en", "s1", 0),
            (5, "   \n\t ", "en", "s2", 3), (None, "no id here at all", "en", "s2", 4), (None, None, None, None, None),
            (6, long_text, "en", "s1", 9), (7, "日本 語 ÀÉÎ \x0b mixed\r\ncontrol", "ja", "s3", 7)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ("score", "held_out", "predicted", "fp", "root", "component_id", "text_key", "n_words", "kept", "quality",
             "slot", "epoch", "block", "mix_row", "n_dropped", "label", "id", "k", "h", "row", "part", "__text", "__stats", "__plain")
    return awkward.select("*", *[F.lit("x").alias(c) for c in names])
