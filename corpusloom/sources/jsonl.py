"""JSON Lines sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import strict_json as J
from corpusloom.functions.text import is_blank
from corpusloom.operators.judging import accepted, nest_verdict, rejected, without_verdict

ORIGIN = "_source_file"


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The record shapes on disk.
CONTRIBUTED = strings("instruction", "input", "output", "category", "subcategory", "difficulty").add(
    "tags", T.ArrayType(T.StringType())
)
ALPACA = strings("instruction", "input", "output", "source", "type", "category", "domain")
GENERATED = strings("instruction", "input", "output", "category", "type")
SECTIONED = strings("prompt", "completion", "input", "source", "type", "category", "domain")


def scan_examples(
    spark: SparkSession, path: str, schema: T.StructType = CONTRIBUTED, glob: str = "*.jsonl"
) -> DataFrame:
    """Every matching file of a folder with the file each row came from.

    The schema is given, so nothing is read twice to infer it; a malformed line
    stops the job; blank lines are skipped. Folders written by
    :func:`write_by_origin` bring the origin along.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", glob).json(path)
    return rows if ORIGIN in rows.columns else rows.withColumn(ORIGIN, F.col("_metadata.file_name"))


def scan_open(spark: SparkSession, path: str) -> DataFrame:
    """As above for records of any shape: one VARIANT ``record`` per line."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl").text(path).withColumn(ORIGIN, F.col("_metadata.file_name"))
    parsed = J.with_json(lines.where(~is_blank(F.col("value"))), "value", "record")
    checked = F.when(F.col("record").isNull(), F.raise_error(F.concat(F.lit("malformed line in "), F.col(ORIGIN))).cast("variant"))
    return parsed.select(checked.otherwise(F.col("record")).alias("record"), ORIGIN)


def strict_log(spark: SparkSession, path: str, example: T.StructType) -> DataFrame:
    """A {prompt, example} log; any bad line stops the job."""
    schema = T.StructType().add("prompt", T.StringType()).add("example", example)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def tolerant_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """A {prompt, example} log read leniently: ``prompt``, ``has_example``, ``example``.

    Lines that are no JSON object or have no prompt are left out. A line with a
    prompt but no example still marks its prompt as done.
    """
    parsed = J.with_json(lines, line, "_json").withColumn("_members", J.as_object(F.col("_json")))
    row = F.struct(
        J.as_text(F.try_element_at("_members", F.lit("prompt"))).alias("prompt"),
        F.map_contains_key("_members", "example").alias("has_example"),
        F.try_element_at("_members", F.lit("example")).alias("example"),
    )
    return parsed.select(F.inline(F.when(F.map_contains_key("_members", "prompt"), F.array(row))))


def scan_records(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """Records of any shape: what the jobs look at as columns, and the whole ``record`` as its JSON.

    No key of a record is lost, null or not. A missing text is an empty one.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    if ORIGIN not in lines.columns:
        lines = lines.withColumn(ORIGIN, F.col("_metadata.file_name"))
    parsed = J.with_json(lines.where(~is_blank(F.col("value"))), "value", "_json").withColumn("_members", J.as_object(F.col("_json")))
    malformed = F.raise_error(F.concat(F.lit("malformed line in "), F.col(ORIGIN))).cast("string")
    texts = {k: F.coalesce(J.as_text(F.try_element_at("_members", F.lit(k))), F.lit("")) for k in ("instruction", "input", "output")}
    return parsed.select(
        *[v.alias(k) for k, v in texts.items()], J.as_text(F.try_element_at("_members", F.lit("category"))).alias("category"),
        F.when(F.col("_members").isNull(), malformed).otherwise(F.to_json("_json")).alias("record"), ORIGIN,
    )


def write_records(df: DataFrame, path: str, *partition_by: str) -> None:
    """The ``record`` column as JSON Lines, every key as it is; in folders by origin if asked for."""
    rows = df.select("record", *partition_by)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).text(path)


def public_columns(df: DataFrame) -> DataFrame:
    """Without the private columns, those named ``_...``."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def write_by_origin(df: DataFrame, path: str) -> None:
    """One folder per origin file.

    Rebalancing gathers small origins into few files and splits an origin that
    holds most rows by size, so neither tiny files nor one giant task appear.
    """
    public = [c for c in df.columns if not c.startswith("_")]
    (
        df.select(*public, ORIGIN)
        .hint("rebalance", ORIGIN)
        .write.mode("overwrite").partitionBy(ORIGIN).json(path, ignoreNullFields=False)
    )


def write_merged(df: DataFrame, path: str) -> None:
    """All rows as one JSON Lines data set: a folder, written where the rows are."""
    public_columns(df).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_clean(judged: DataFrame, path: str) -> None:
    write_by_origin(without_verdict(accepted(judged)), path)


def write_rejects(judged: DataFrame, path: str) -> None:
    """Rejected rows with their verdict nested under ``_qc``."""
    rows = nest_verdict(rejected(judged))
    public = [c for c in rows.columns if not c.startswith("_")]
    rows.select(*public, "_qc").write.mode("overwrite").json(path, ignoreNullFields=False)
