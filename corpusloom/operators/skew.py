"""Lookups that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.session import stage, work_dir


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` joined with ``lookup``, which has one row per key.

    The narrow lookup is written out first. So both sides of the join come
    straight from a shuffle, and the adaptive skew join splits the rows of a hot
    key by their bytes; below an aggregation, as lookups usually are, it could not.
    Nothing is counted beforehand and no column of ``rows`` is read for it.
    """
    return rows.join(stage(lookup, work_dir(rows.sparkSession, "lookup")), key, how)
