"""Model calls in rounds until every key has an acceptable answer or rounds run out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.inference import infer, infer_packed, message_tokens
from corpusloom.operators.planning import remaining_work
from corpusloom.session import stage
from corpusloom.sources import manifest
from corpusloom.streaming.log import append_batch, open_log, read_log


def call_rounds(
    plan: DataFrame,
    fn: Callable[[pd.Series], pd.Series],
    accept: Callable[[DataFrame], DataFrame],
    path: str,
    schema: T.StructType,
    key: str,
    prompts: Sequence[str],
    tasks: int | None = None,
    slices: int = 8,
    answer_tokens: str | None = None,
    budget: int | None = None,
    in_flight: int | None = None,
) -> DataFrame:
    """Ask once per round for the keys still open; return the log of results.

    ``plan`` has one row per key and the prompt columns; ``prompts`` names the
    column of each round, so a retry repeats a name and a fallback brings
    another. ``accept`` maps (key, raw) to rows of ``schema``, none for an answer
    that fails. Answers are stored before they are parsed, a round in ``slices`` of
    its keys: what a stopped job has stored of a round is read when it is started
    anew on the same path, and only the slice it stopped in is asked again.

    A column of messages may take the place of a prompt. ``answer_tokens`` names the column
    of how many tokens an answer may have: ``fn`` then gets a frame of both, and with a
    ``budget`` the calls of messages are packed into tasks of about so many tokens.
    """
    open_log(plan.sparkSession, f"{path}/results", schema)
    first = _next_round(plan.sparkSession, path)
    for number, prompt in enumerate(prompts, first):
        log = read_log(plan.sparkSession, f"{path}/results", schema)
        names = [prompt] if answer_tokens is None else [prompt, answer_tokens]
        todo = remaining_work(plan, log, key, unique=True).select(key, *names)

        def ask(rows: DataFrame) -> DataFrame:
            asked = prompt if answer_tokens is None else names
            if budget is None:
                return infer(rows, fn, key, asked, tasks, in_flight)
            return infer_packed(rows, fn, key, asked, message_tokens(prompt, answer_tokens), budget, in_flight)

        answers = _answers(todo, ask, key, f"{path}/answers/round={number}", slices)
        append_batch(accept(answers), number, f"{path}/results", schema, key, run="rounds")
        manifest.put_text(plan.sparkSession, f"{path}/rounds/{number:06d}", "")
    return read_log(plan.sparkSession, f"{path}/results", schema)


def _next_round(spark: SparkSession, path: str) -> int:
    """The round to go on with: the one behind the last that was finished, with results or without."""
    return max((int(n) + 1 for n in manifest.names_in(spark, f"{path}/rounds") if n.isdigit()), default=0)


def _answers(todo: DataFrame, ask: Callable[[DataFrame], DataFrame], key: str, path: str, slices: int) -> DataFrame:
    """(key, raw) of a round, slice by slice; slices that were written to their end are not asked for again.

    What is to be asked is found out once a round, and written in slices.
    """
    spark = todo.sparkSession
    cut = todo.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(slices)).cast("int"))
    asked = _once(cut, f"{path}/todo", "_slice")
    done = None
    for k in range(slices):
        stored = _once(ask(asked.where(F.col("_slice") == k).drop("_slice")), f"{path}/slice={k}/whole")
        done = stored if done is None else done.unionByName(stored)
    return done


def _once(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """The table at ``path``, written first unless it was written to its end before."""
    if manifest.is_whole(df.sparkSession, path):
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return stage(df, path, *partition_by)
