"""Small tables and reference computations for the tests of this folder."""

import re

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
SAMPLE = "/root/testdata/sf0.01"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
SPACES = " \t\n\x0b\x0c\r"


def documents(spark, texts, ids=None, sources=None):
    rows = [
        (
            i if ids is None else ids[i],
            text,
            "en",
            "src0" if sources is None else sources[i],
            None if text is None else len(text),
        )
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def by(df, key):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
