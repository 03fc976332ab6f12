"""Small tables for the operators: edge cases, and the documents of the smallest scale."""

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("score", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("block", T.StringType()), T.StructField("label", T.StringType())])

LINE = "The quick brown fox jumps over the lazy dog while nine wise owls look on from the old oak."


def rows():
    texts = [
        (1, LINE), (2, None), (3, ""), (4, LINE), (5, "x"), (6, " \t\n "),
        (7, LINE + " " + LINE), (8, "é" * 3000), (9, "word " * 4000),
        (10, LINE.upper()), (11, "don't stop 'til 3.14 €5 中文 \U0001F600 <|endoftext|> it's"),
        (12, "x"), (12, "x"), (13, "a different text altogether, with nothing in common"),
        (None, LINE), (None, None), (14, "Z" * 200), (15, "Z" * 199),
        (16, LINE.replace("nine", "ten"))]
    return [(i, t, "en" if t else None, "s", None if t is None else len(t),
             "s", "k", "b", "l") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
