"""Small tables for golden cases."""

from pyspark.sql import functions as F


def evaluate(spark, values, build):
    """Apply ``build`` to a string column and return the results in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string").repartition(2)
    return [r["out"] for r in df.select("i", build(F.col("s")).alias("out")).orderBy("i").collect()]


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)
