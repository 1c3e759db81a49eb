"""Which folders a data set consists of, as numbered versions.

A data set that changes while others read it keeps its rows in folders that are
written once. A version is a small JSON text that names the live ones. It is
written under another name and then renamed, so a reader sees a version whole or
not at all, and goes on with the folders it found there while later versions come.
One job at a time writes to a data set; a second one fails at its commit.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSIONS, DATA = "_versions", "data"
# Versions whose folders a clean-up leaves alone, for readers that started with them.
KEPT_VERSIONS = 16


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: the mark that Spark leaves last is there."""
    return exists(spark, f"{path}/_SUCCESS")


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text, whole or not at all; False where there is one already."""
    fs, place = _file_system(spark, path)
    if fs.exists(place):
        return False
    _, draft = _file_system(spark, f"{place.getParent()}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    return fs.rename(draft, place)


def get_text(spark: SparkSession, path: str) -> str | None:
    fs, place = _file_system(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{path}/{VERSIONS}") if n.endswith(".json") and n[0] != ".")


def _content(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(get_text(spark, f"{path}/{VERSIONS}/{number:020d}.json"))


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the live version; (-1, {}) before the first."""
    numbers = _numbers(spark, path)
    return (numbers[-1], _content(spark, path, numbers[-1])) if numbers else (-1, {})


def commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Make ``content`` the live version; ``content["folders"]`` names all its folders."""
    if not put_text(spark, f"{path}/{VERSIONS}/{number:020d}.json", json.dumps(content)):
        raise RuntimeError(f"version {number} of {path} is there: two jobs write to it")


def new_folder(name: str) -> str:
    """A fresh folder below the data set."""
    return f"{DATA}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete folders and versions that the last ``keep`` versions don't need; for the job that writes.

    A version may name a folder or folders inside one, ``data/x`` or ``data/x/bucket=1``.
    """
    numbers = _numbers(spark, path)
    live: dict[str, set[str]] = {}  # folders inside a folder of the data set
    for n in numbers[-keep:]:
        for folder in _content(spark, path, n)["folders"]:
            _, name, *inner = folder.split("/")
            live.setdefault(name, set()).update(inner)
    for name in names_in(spark, f"{path}/{DATA}"):
        if name not in live:
            remove(spark, f"{path}/{DATA}/{name}")
        elif live[name]:
            for inner in names_in(spark, f"{path}/{DATA}/{name}"):
                if "=" in inner and inner not in live[name]:
                    remove(spark, f"{path}/{DATA}/{name}/{inner}")
    for n in numbers[:-keep]:
        remove(spark, f"{path}/{VERSIONS}/{n:020d}.json")


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some folders; folders inside them are no columns."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{path}/{f}" for f in folders])


def publish(df: DataFrame, path: str, name: str = "rows") -> None:
    """A table that takes the place of the one before in one step."""
    spark = df.sparkSession
    number, _ = latest(spark, path)
    folder = new_folder(name)
    df.write.parquet(f"{path}/{folder}")
    commit(spark, path, number + 1, {"folders": [folder], "schema": df.schema.json()})
    clean_up(spark, path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table that was published last."""
    number, content = latest(spark, path)
    if number < 0:
        raise FileNotFoundError(f"nothing was published at {path}")
    return read_folders(spark, path, content["folders"], T.StructType.fromJson(json.loads(content["schema"])))
