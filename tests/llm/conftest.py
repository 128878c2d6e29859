import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# NULLs in every column, empty and blank texts, repeated rows and ids, extra columns named like internal ones
ODD_DOCS = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (None, "no id here at all", "en", "a", 17), (None, None, None, None, None),
    (3, " \n\t ", "de", "b", 4), (4, "one", "en", "a", 3), (4, "one", "en", "a", 3), (5, "One", "en", "b", 3),
    (6, "a b c d e f", "en", None, 11), (6, "another text under the same id", "en", "b", 30), (7, "é ñ 中文 😀\x00 x", "fr", "", 10),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA)
    for c in ("size", "h", "fp", "key", "row", "component_id", "label", "score", "file", "nth"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
