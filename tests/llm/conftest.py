import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, an extra column
    whose name may clash with an operator's own."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, long, None, "b", len(long)), (4, " \n\t ", "de", "a", 4),
            (5, "same words in the same order here", "en", "a", 33), (6, "same words in the same order here", "en", "b", 33),
            (6, "same words in the same order here", "en", "b", 33), (None, "text of a row without an id", "fr", "a", 27)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "doc_id AS _idx", "source AS kind", "n_chars AS length", "text AS spans")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
