"""Operator 10: substring deduplication by sliding sentence spans.

A sentence ends with a line, or with . ! or ? before white space. From every
sentence of a text the span of the fewest successive sentences (MIN_SENTENCES at
least) that holds MIN_WORDS words is hashed, and so is the one that ends with it:
together these cover every sentence of any longer run that repeats. One sentence
of MIN_WORDS words that fills its whole line counts as well, since nothing longer
may repeat around it.
All spans are joined by hash over the whole corpus. The first occurrence, by
document id and place, stays; sentences covered by any other are removed. Words
are compared as they are but for white space and the case of A-Z.

Rows of one doc_id are one document: repeated rows are no repetition. Rows
without an id hold no spans and stay as they are. Null and empty texts have no
sentences; ties in place cannot occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import texts
from corpusloom.session import stage, work_dir

MIN_WORDS = 25
MIN_SENTENCES = 2

SPAN_DDL = "hash long, doc_id long, begin int, finish int, n_words int"
SPAN_SCHEMA = pa.schema([
    ("hash", pa.int64()), ("doc_id", pa.int64()), ("begin", pa.int32()), ("finish", pa.int32()), ("n_words", pa.int32()),
])
_STEP = 0x9E3779B97F4A7C15
_STOP = texts.byte_class(b".!?")


def spans_of(column: pa.Array, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES):
    """(text number, hash, first byte, byte behind, words) of every span."""
    raw, at = texts.flat(column)
    w = texts.words(raw, at)
    n = len(w.hash)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none
    # where a line ends behind a word: no line break lies between it and the next word otherwise
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    line = breaks[w.start]
    last = np.ones(n, bool)
    last[:-1] = _STOP[raw[w.end[:-1] - 1]] | (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
    line_ends = np.ones(n, bool)
    line_ends[:-1] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
    ends = np.flatnonzero(last) + 1  # word behind each sentence
    begins = np.concatenate([[0], ends[:-1]])
    doc = w.doc[begins]
    # the sentence that closes a span: the first with enough words and enough sentences behind its begin
    k = np.maximum(np.searchsorted(ends, begins + min_words, "left"), np.arange(len(begins)) + min_sentences - 1)
    alone = line_ends[ends - 1] & ((begins == 0) | line_ends[begins - 1]) & (ends - begins >= min_words)
    ok = (k < len(begins)) & (doc[np.minimum(k, len(begins) - 1)] == doc)
    # the sentence that opens a span: the last with enough words and enough sentences up to the end; not if it is a span already
    i = np.arange(len(ends))
    j = np.minimum(np.searchsorted(begins, ends - min_words, "right") - 1, i - min_sentences + 1)
    back_ok = (j >= 0) & (doc[np.maximum(j, 0)] == doc) & (k[np.maximum(j, 0)] != i)
    # prefix sums of hash * step^place, times step^-begin, give every span's hash wherever it stands
    powers = np.multiply.accumulate(np.full(n, np.uint64(_STEP), np.uint64))
    back = np.multiply.accumulate(np.full(n, np.uint64(pow(_STEP, -1, 1 << 64)), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * powers, dtype=np.uint64)])
    out = []
    for first, close in ((begins[ok], ends[k[ok]]), (begins[j[back_ok]], ends[back_ok]), (begins[alone], ends[alone])):
        value = (sums[close] - sums[first]) * back[first]
        out.append((w.doc[first], texts.mix(value ^ (close - first).astype(np.uint64)), w.start[first] - at[w.doc[first]],
                    w.end[close - 1] - at[w.doc[first]], close - first))
    return tuple(np.concatenate(x) for x in zip(*out))


def spans(docs: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES) -> DataFrame:
    """(hash, doc_id, begin, finish, n_words) of every span; places in bytes of UTF-8."""

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, hashed, a, b, n = spans_of(part.column("text"), min_words, min_sentences)
        yield texts.record(SPAN_SCHEMA, hashed.view(np.int64), part.column("doc_id").take(pa.array(doc)), a, b, n)

    return texts.map_texts(docs.where(F.col("doc_id").isNotNull()), work, SPAN_DDL)


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES) -> DataFrame:
    """(doc_id, begin, finish, n_words, first_doc_id) of every span that is not the first of its hash."""
    spark = docs.sparkSession
    found = stage(spans(docs, min_words, min_sentences), work_dir(spark, "spans"))
    first = F.min(F.struct(F.col("doc_id").alias("first_doc_id"), F.col("begin").alias("first_begin"))).alias("first")
    last = F.max(F.struct("doc_id", "begin")).alias("last")
    firsts = found.groupBy("hash").agg(first, last).where("first.first_doc_id <> last.doc_id or first.first_begin <> last.begin")
    # written out, so that the join below reads two tables and a hot hash can be split
    firsts = stage(firsts.select("hash", "first.first_doc_id", "first.first_begin"), work_dir(spark, "first-spans"))
    return (
        found.join(firsts, "hash").where("doc_id <> first_doc_id or begin <> first_begin")
        .select("doc_id", "begin", "finish", "n_words", "first_doc_id")
    )


def removed_stretches(docs: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES) -> DataFrame:
    """(doc_id, begin, finish, first_doc_id): overlapping and adjoining spans united; the smallest first document of each."""
    order = Window.partitionBy("doc_id").orderBy("begin", "finish", "first_doc_id")
    before = F.max("finish").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("begin") > before + 1)).cast("int")
    return (
        repeated_spans(docs, min_words, min_sentences)
        .withColumn("opens", opens).withColumn("stretch", F.sum("opens").over(order))
        .groupBy("doc_id", "stretch")
        .agg(F.min("begin").alias("begin"), F.max("finish").alias("finish"), F.min("first_doc_id").alias("first_doc_id"))
        .drop("stretch")
    )


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES) -> DataFrame:
    """The documents with the repeated stretches cut out of ``text``; all rows and other columns stay as they are."""
    cuts = removed_stretches(docs, min_words, min_sentences).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("begin", "finish"))).alias("_llm_cuts")
    )
    cuts = stage(cuts.withColumnRenamed("doc_id", "_llm_id"), work_dir(docs.sparkSession, "cuts"))
    joined = docs.join(cuts, docs["doc_id"] == cuts["_llm_id"], "left")
    raw = F.col("text").cast("string").cast("binary")
    # what lies between two cuts; bytes, since the places are bytes
    bounds = F.concat(
        F.array(F.struct(F.lit(0).alias("begin"), F.lit(0).alias("finish"))), F.col("_llm_cuts"),
        F.array(F.struct(F.octet_length("text").alias("begin"), F.lit(0).alias("finish"))),
    )
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(bounds) - 1),
        lambda k: F.substring(raw, F.element_at(bounds, k).finish + 1, F.element_at(bounds, k + 1).begin - F.element_at(bounds, k).finish),
    )
    text = F.when(F.col("_llm_cuts").isNull(), F.col("text")).otherwise(
        F.decode(F.aggregate(pieces, F.lit(b""), lambda a, b: F.concat(a, b)), "UTF-8")
    )
    return joined.withColumn("text", text).select(*docs.columns)
