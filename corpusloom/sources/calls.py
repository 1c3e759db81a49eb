"""The records of calls, replaced call by call.

Calls share buckets by a hash of their id. The number of buckets is kept with the
data and grows with it by linear hashing: a further bucket takes its rows from one
other, so a write splits as many buckets as it adds and leaves the rest alone. A
write reads and writes the buckets of its own calls and those it splits, about
BUCKET_ROWS rows each, and then commits a version that names the new folder of
each of them (sources.manifest). Stopped at any point, it has changed nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.winners import rows_at
from corpusloom.session import own_tables, stage, work_dir
from corpusloom.sources import manifest

BUCKET = "_bucket"
# Rows of a bucket, on average, before one is split.
BUCKET_ROWS = 1 << 18


def bucket_of(call: str, buckets: int) -> Column:
    """Of ``buckets`` buckets the one a call belongs to."""
    round_up = 1 << (buckets - 1).bit_length()
    wide = F.pmod(F.xxhash64(call), F.lit(round_up))
    return F.when(wide < buckets, wide).otherwise(wide - round_up // 2).cast("int")


def origin_of(bucket: int, buckets: int) -> int:
    """Where the rows of a bucket were when there were only ``buckets``."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def overwrite_calls(records: DataFrame, path: str, call: str = "call_id", bucket_rows: int = BUCKET_ROWS) -> None:
    """Replace the records of exactly the calls in ``records``; all other calls stay as they are.

    Writing the same call again leaves one copy. Columns that only the old or only
    the new records have are null in the others. A null id is a call like any other.
    """
    with own_tables(records.sparkSession):
        _overwrite(records, path, call, bucket_rows)


def _overwrite(records: DataFrame, path: str, call: str, bucket_rows: int) -> None:
    spark = records.sparkSession
    number, content = manifest.latest(spark, path)
    old, held = content.get("buckets", {}), content.get("count", 1)
    new = stage(records, work_dir(spark, "calls"))
    count = max(held, -(-(sum(b["rows"] for b in old.values()) + new.count()) // bucket_rows))

    # at most as many numbers as there are buckets
    touched = {r[0] for r in new.select(bucket_of(call, count)).distinct().collect()} | set(range(held, count))
    rewritten = {origin_of(b, held) for b in touched}
    schema = T.StructType.fromJson(json.loads(content["schema"])) if old else new.schema
    before = manifest.read_folders(spark, path, [old[str(b)]["folder"] for b in sorted(rewritten) if str(b) in old], schema)
    kept = _without(before, new, call) if rewritten & {int(b) for b in old} else before
    rows = kept.unionByName(new, allowMissingColumns=True)

    folder = manifest.new_folder("calls")
    rows.withColumn(BUCKET, bucket_of(call, count)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    sizes = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{path}/{folder}")
    buckets = {b: x for b, x in old.items() if int(b) not in rewritten}
    for b, n in sizes.groupBy(BUCKET).count().collect():  # no column is read for it
        buckets[str(b)] = {"folder": f"{folder}/{BUCKET}={b}", "rows": n}
    manifest.commit(spark, path, number + 1, {
        "folders": [b["folder"] for b in buckets.values()], "buckets": buckets, "count": count, "schema": rows.schema.json(),
    })
    manifest.clean_up(spark, path)


def _without(before: DataFrame, new: DataFrame, call: str) -> DataFrame:
    """The stored rows whose call is not written anew, picked by their place in the files."""
    placed = before.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    replaced = new.select(F.col(call).alias("_replaced")).distinct()
    kept = placed.select(call, "_file", "_row").join(replaced, F.col(call).eqNullSafe(F.col("_replaced")), "left_anti")
    return rows_at(placed, kept, "_row", "_file").select(*before.columns)


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """The records of all calls."""
    number, content = manifest.latest(spark, path)
    if number < 0:
        raise FileNotFoundError(f"no calls were written to {path}")
    return manifest.read_folders(spark, path, content["folders"], T.StructType.fromJson(json.loads(content["schema"])))
