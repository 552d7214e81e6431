"""Rows with nulls, empty and long texts, ties, repeats and extra columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table of (doc_id, text, lang, source), with columns whose names operators use."""
    full = [(i, t, g, s, len(t or "")) for i, t, g, s in rows]
    df = spark.createDataFrame(full, DOCS)
    extra = {"bucket": "1", "digest": "'x'", "rank": "2", "n": "3", "_m": "4", "keep_id": "5", "key": "6"}
    extra |= {"_id": "7", "_text": "8", "_copies": "9", "_copy": "10", "row": "11", "copies": "12", "taken": "13", "h": "14"}
    return df.withColumns({name: F.expr(value) for name, value in extra.items()})


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], T.StructType.fromDDL(schema))


def odd_rows():
    long_text = "word " * 30_000
    return [
        (1, None, None, None),
        (2, "", "en", ""),
        (3, "   \n", "en", "src1"),
        (4, "Same Text here for two", "en", "src0"),
        (5, "same text HERE for two", None, "src0"),
        (6, "ÉCOLE", "fr", "src1"),
        (7, "école", "fr", None),
        (8, long_text, "en", "src0"),
        (9, long_text, "en", "src0"),
        (10, "x" * 100_000, "de", "src2"),
        (11, "7" * 50_000, None, "src2"),
        (12, "a.b" * 20_000 + "@c" + ".d" * 20_000, None, "src2"),
    ]
