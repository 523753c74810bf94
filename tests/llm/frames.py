"""Small documents with everything that may be wrong with documents."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _d long, base string"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, clashing names."""
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "other text of the same id"),
            (2, None), (3, ""), (4, "   \n\t"), (None, "no id here at all really"), (None, None), (5, LONG), (6, LONG + " end"),
            (7, "One TWO three four five six"), (8, "ünï cödé \x1c 語 \U0001f600"), (9, "x")]
    data = [(i, t, None, [None, "a", "b"][n % 3], None, "text", n, "c") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return odd_documents(spark).where(F.lit(False))
