"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage, work_dir


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``: the smallest node that can be reached.

    Alternates between hanging each node's larger neighbours, then each node and
    its smaller neighbours, on its smallest one, until every node hangs on the
    smallest node of its component. Rounds grow with the logarithm of the
    component's size; each is written to the shared folder.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = stage(edges, work_dir(spark, "links")), None
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen["n"] == 0 or seen == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).groupBy("node").agg(F.min("component").alias("component"))
        state = seen
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written out before the join, so that a node with very many neighbours can be split
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = stage(least, work_dir(spark, "least"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), work_dir(spark, "links"))
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), work_dir(spark, "least"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), work_dir(spark, "links"))
