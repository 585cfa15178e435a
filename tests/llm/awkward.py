"""Rows that every operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and" for i in range(40_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again until the evening comes", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog again and again until the evening comes", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog again and again until the evening comes", None, None),
    (3, None, "en", "b"),
    (4, "", None, "b"),
    (5, " \t\n ", "de", "c"),
    (None, "Der schnelle Fuchs springt am Abend über den faulen Hund und läuft danach nach Hause", "de", "c"),
    (None, None, None, None),
    (6, "Der schnelle Fuchs springt am Abend über den faulen Hund und läuft danach nach Hause", "de", "c"),
    (7, LONG, "en", "a"),
    (8, "12345 67890 ...", "fr", "d"),
    (9, "one", "en", "d"),
    (10, "\U0001F600 \u00e9\u00e8 \ufeff \x00 odd", "fr", "d"),
]
CLASHING = ["score", "predicted", "passages", "matches", "lang_pred", "rejected", "shard", "block", "size", "bucket", "row", "order", "data", "rule", "host",
            "path", "set_id", "kept", "_row", "_judged", "start", "target", "a", "b", "bits", "template", "first"]
SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark: SparkSession) -> DataFrame:
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def no_documents(spark: SparkSession) -> DataFrame:
    return documents(spark).limit(0)


def labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 1), (7, 0, 1), (7, 0, 1), (9, None, None), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
