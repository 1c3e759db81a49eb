"""The model call as an injected function over batches of prompts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.skew import lookup_join
from corpusloom.session import stage, work_dir

# Characters that count as a token where no better estimate is given.
CHARS_PER_TOKEN = 4
# Tasks of packed calls: this many, or so many times the cores, if that is more. Each costs a start, and a fetch from every task before it.
MOST_TASKS, TASKS_PER_CORE = 1 << 9, 8

Model = Callable[[pd.Series], pd.Series] | Callable[[pd.DataFrame], pd.Series]


def infer(
    df: DataFrame, fn: Model, key: str, prompt: str | Sequence[str] = "prompt", tasks: int | None = None, in_flight: int | None = None
) -> DataFrame:
    """Add ``raw``: ``fn`` applied to Arrow batches of prompts, next to the key.

    ``fn`` returns one text per prompt, null for a failed call. It gets a series of
    prompts, texts or messages; of several columns (messages and a token limit, say)
    a frame. ``tasks`` bounds how many calls run at once, ``in_flight`` how many a task
    hands to ``fn`` at a time. Subtract finished work ahead of this job: nothing moves through it.
    """
    names = [prompt] if isinstance(prompt, str) else list(prompt)
    rows = df.select(key, *names)
    return _call(rows.repartition(tasks) if tasks else rows, fn, key, prompt, in_flight)


def _call(rows: DataFrame, fn: Model, key: str, prompt: str | Sequence[str], in_flight: int | None) -> DataFrame:
    asked = prompt if isinstance(prompt, str) else list(prompt)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, raw string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), in_flight or max(1, len(batch))):
                part = batch.iloc[a : a + (in_flight or len(batch))]
                yield pd.DataFrame({key: part[key].to_numpy(), "raw": pd.Series(fn(part[asked])).to_numpy()})

    return rows.mapInPandas(run, schema)


def message_tokens(messages: str, answer: str) -> Column:
    """About how many tokens a call costs: those of its messages and the most its answer may have."""
    chars = F.aggregate(messages, F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))
    return F.ceil(chars / CHARS_PER_TOKEN).cast("long") + F.coalesce(F.col(answer).cast("long"), F.lit(0))


def with_bins(df: DataFrame, key: str, weight: Column, budget: int) -> tuple[DataFrame, int]:
    """Add ``_bin``, and how many there are: rows in a row whose weights before them fill ``budget`` so many times.

    A bin's weights sum up to less than the budget and one row. ``key`` is unique. Sums
    are built from keys and weights alone: inside ranges of keys, then over the ranges, of
    which there are as many as tasks.
    """
    spark = df.sparkSession
    cost = F.greatest(F.coalesce(weight.cast("long"), F.lit(0)), F.lit(0))
    ranges = df.select(key, cost.alias("_cost")).repartitionByRange(key).withColumn("_range", F.spark_partition_id())
    ranges = stage(ranges, work_dir(spark, "calls-cost"))
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("_range").agg(F.sum("_cost").alias("_sum"))
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    start = F.col("_offset") + F.coalesce(F.sum("_cost").over(inside), F.lit(0))
    bins = ranges.join(offsets, "_range").select(key, F.floor(start / budget).cast("long").alias("_bin"))
    bins = stage(bins, work_dir(spark, "calls-bins"))
    return lookup_join(df, bins, key), (bins.agg(F.max("_bin")).first()[0] or 0) + 1


def infer_packed(
    df: DataFrame, fn: Model, key: str, prompt: str | Sequence[str], weight: Column, budget: int, in_flight: int | None = None
) -> DataFrame:
    """As :func:`infer`, with calls of about ``budget`` tokens in each task, so that tasks end alike.

    ``weight`` is what a call costs (:func:`message_tokens`); one dearer than the budget has a task to itself.
    Where that makes more tasks than MOST_TASKS, each has as many budgets in a row as it takes.
    """
    names = [prompt] if isinstance(prompt, str) else list(prompt)
    rows, n = with_bins(df, key, weight, budget)
    tasks = min(n, max(MOST_TASKS, TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism))
    task = F.floor(F.col("_bin") * tasks / n).cast("int")
    return _call(rows.repartitionById(tasks, task).select(key, *names), fn, key, prompt, in_flight)
