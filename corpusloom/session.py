"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime settings the jobs are written for. None of them changes a plan's
# meaning except allowDuplicateKeys, which makes a repeated JSON key keep its
# last value instead of rejecting the text.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # where every partition of the narrow lookup side proves small, hash it and
    # leave the wide text side unsorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    # texts go to Python by their bytes; 10,000 long ones, the default, fill a worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # staged texts are written once and read a few times
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to an existing session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is refused.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


_owner: ContextVar[str] = ContextVar("owner", default="")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/corpusloom/{_owner.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted on leaving: for jobs whose results are written by then."""
    name = f"own-{uuid.uuid4().hex}/"
    token = _owner.set(_owner.get() + name)
    place = f"{shared_root(spark)}/corpusloom/{_owner.get()}"
    try:
        yield
    finally:
        _owner.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(place)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write once, read many: the written table cuts the lineage.

    Unlike a cached frame it survives the loss of executors, and later readers
    scan only the columns and partitions they need.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # the written schema is known: no footer sampling on the way back
    return df.sparkSession.read.schema(df.schema).parquet(path)
