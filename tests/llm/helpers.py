"""Small frames shared by the tests of the training-data operators."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Extra columns whose names operators use themselves.
CLASH = ("score", "class", "ids", "key", "node", "block", "_m", "_k", "_key", "_class", "_best", "_id", "_bumps",
         "component", "label", "n_links")


def docs(spark, rows, clash=False):
    """Documents from (doc_id, text) pairs."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASH:
            df = df.withColumn(c, F.lit("mine"))
    return df


def edge_rows():
    """Null id, null text, empty, blank, punctuation, one word, very long, repeated rows and equal texts."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    same = "the same text twice over in a row of words"
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "!!! ???"), (5, "one"), (6, long), (7, same), (8, same), (8, same),
            (None, same), (None, None), (9, "naïve Öl 漢字 \U0001f600 ▁ end")]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
