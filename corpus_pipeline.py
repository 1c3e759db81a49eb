"""From raw documents to encoded training texts, in five stages.

Each stage takes (spark, docs, sf_dir), does its operator's whole job on the rows
it is given, and returns a DataFrame that is written before the next one reads
it. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, jaccard, leaks, pii, quality
from corpusloom.session import configure, stage, work_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the smallest document of each group of near copies stays."""
    return jaccard.one_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that leak an item go."""
    return leaks.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span becomes the name of its kind, and n_chars follows the text."""
    masked = pii.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-pair encoding and decoding: ids of each text, and whether they give the text back."""
    coded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("PII", masked_documents),
    ("BPE encoding and decoding", encoded_documents),
]

# The classifier and the tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; the result of each is written to the shared folder."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), work_dir(spark, name.replace(" ", "-").lower()))
    return STAGES[-1][1](spark, docs, sf_dir)
