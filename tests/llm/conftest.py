import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
#: Names that the operators use themselves.
CLASHES = ["id", "fp", "node", "class", "row", "key", "h", "size", "start", "pos", "lines", "range", "rn",
           "component", "u", "v", "n", "words", "target", "passes", "slice", "tie", "halo", "blob", "kind",
           "left", "drop", "at", "votes", "t", "line", "p", "row_key", "found", "text_", "grade"]
LONG = "wörd " * 40_000 + "x" * 100_000 + " 1" * 30_000 + " end\n" * 2_000


@pytest.fixture(scope="session", autouse=True)
def workers_find_package(spark):
    from reelmart.llm._common import find_package
    find_package(spark)


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, long, repeated and tied rows."""
    return [(None, "no id here", "en", "a", 10), (None, "no id here", "en", None, 10), (1, None, None, None, None),
            (2, "", "en", "a", 0), (3, " \t\n\x0b ", "en", "b", 5), (4, "Hello", "en", "b", 5),
            (5, LONG, "en", "c", len(LONG)), (6, "same text twice", "en", "a", 15), (6, "same text twice", "en", "a", 15),
            (6, "another text of six", "en", "a", 19), (7, "same text twice", "de", "c", 15),
            (8, "😀 é ﬀ Ünï\x00cödé line\r\nend", "xx", "c", 20), (9, "a b c d e", "en", "é", 9),
            (-3, "a b c d f", "en", "", 9)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(edge_rows, schema)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def documents(spark, sf_dir=SF01):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
