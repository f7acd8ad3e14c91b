"""Awkward documents that every operator must take."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet consectetur " * 8000  # about 300,000 characters

#: Names that operators use inside, as extra columns.
CLASHING = ["row", "k1", "k2", "h", "node", "copies", "score", "n_tokens", "ids", "found",
            "label", "class_id", "line", "_epoch", "_row", "component"]

DOCUMENTS = [
    (1, "The quick brown fox jumps over the lazy dog\nfooter line", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog\nfooter line", "en", "a"),  # repeated row
    (2, None, "en", "b"),
    (3, "", None, "b"),
    (4, LONG, "la", "c"),
    (None, "A document without an id\nfooter line", "en", None),
    (5, "  \n\t \n", None, None),
    (6, "12 34 !!", "en", "a"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund 🙂\nfooter line", "de", "c"),
    (8, "The quick brown fox jumps over the lazy dog\nfooter line", None, "b"),  # a copy
]


def documents(spark, rows=None):
    schema = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType())])
    rows = DOCUMENTS if rows is None else rows
    schema = schema.add("n_chars", T.LongType())
    for name in CLASHING:
        schema = schema.add(name, T.StringType())
    return spark.createDataFrame(
        [(*r, len(r[1]) if r[1] is not None else None, *["x"] * len(CLASHING)) for r in rows],
        schema)


def empty(spark):
    return documents(spark, [])
