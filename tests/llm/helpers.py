"""Small tables with every awkward case, for all operators."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 66),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "  \t\n ", "de", "b", 5),
    (5, "12345 !!! 67", "fr", None, 12),
    (6, "one", "en", "b", 3),
    (None, "no id here but a text of some words all the same", "en", "a", 1),
    (7, "über die Straße gehen wir zum Markt und kaufen Brot " * 3000, "de", "b", 1),
    (8, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "b", 66),
    (8, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "b", 66),
    (9, "émoji 🙂🙂 und\x00null", "fr", "a", 5),
    (-3, "minus three is an id like any other", "en", "c", 5),
]


def docs(spark, rows=ODD):
    """The rows with columns whose names clash with what operators add."""
    df = spark.createDataFrame(rows, DOCS)
    for name in ("score", "size", "sources", "row", "digests", "Text_", "cls", "repeats", "place"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def by_id(df):
    return {r[0]: r for r in df.collect()}
