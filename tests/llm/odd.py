"""Small tables with every awkward case."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"word{k}" + ("." if k % 12 == 11 else "") for k in range(72))


def documents(spark, rows):
    """rows: (doc_id, text); with columns whose names clash with those used inside."""
    full = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(3)
    clash = ("score", "label", "hash", "ids", "n", "a", "b", "u", "v", "base", "spans", "shingle", "group", "_id", "component", "begin")
    return df.withColumns({c: F.lit("x") for c in clash})


def empty(spark):
    return documents(spark, [])


LONG = "alpha beta gamma " * 30_000
ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, PASSAGE), (7, PASSAGE), (7, PASSAGE), (8, PASSAGE + " more"),
    (None, PASSAGE), (None, None), (9, LONG), (10, "漢字 😀 é ß   x"), (11, "\x00 zero"), (12, "!" * 3000),
]
