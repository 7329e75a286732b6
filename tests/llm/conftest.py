import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.01"
LONG = "word " * 60_000
#: Rows that every operator must take: null and empty texts, ties, repeats,
#: a null id and source, a very long text, and a column named like an internal one.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), T.StructField("rid", T.StringType()),
                       T.StructField("size", T.StringType())])
ODD = [(1, "same text here twice over", "en", "a", 1, "x", "y"),
       (2, "same text here twice over", "en", "a", None, None, None),
       (3, None, None, None, None, None, None),
       (4, "", "en", "b", 0, "", ""),
       (5, LONG, "en", "b", 0, "", ""),
       (6, LONG + "end", "en", None, 0, "", ""),
       (7, "SAME text here twice over", "en", "é", 1, "", ""),
       (7, "SAME text here twice over", "en", "é", 1, "", ""),
       (8, " \t\n ", "en", "a", 4, "", ""),
       (9, "漢字 é ñ 🙂 'Tis it's", "xx", "a", 9, "", ""),
       (None, "no id at all", "en", "a", 1, "", ""),
       (10, "x" * 50_000, "en", "c", 1, "", "")]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return sorted((r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect())
