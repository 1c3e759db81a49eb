"""The bounded sample of labelled rows that classifiers are fitted on.

Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1.
Of these the SAMPLE_ROWS with the smallest hashes are taken, so the fit costs
the same at any corpus size; everything is scored. Where whole texts could still
be too much for one place, a bound on their bytes leaves out further rows, each
with all its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows a classifier is fitted on at most.
SAMPLE_ROWS = 6_000


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is such a row."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, max_bytes: int | None = None) -> DataFrame:
    """(doc_id, text, label) of the rows to fit on, at most ``rows``; rows without a label or text column value count as such.

    With ``max_bytes`` the texts are taken by ascending hash of their id as long as they fit; one that does not is passed over.
    """
    known = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # at most ``rows`` pairs of numbers
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    if max_bytes is None:
        return found
    # copies of an id count together, so that all of them are taken or none
    size = found.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
    taken, room = [], max_bytes
    for r in size.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if r["size"] <= room:
            taken.append((r["doc_id"],))
            room -= r["size"]
    return found.join(F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long")), "doc_id", "left_semi")
