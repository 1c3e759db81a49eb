"""One row per key, chosen by narrow columns and fetched late."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage, work_dir

# Bitmaps, of 32,768 row numbers each, that go to every task; rows with more of them meet their numbers in a shuffle.
MOST_BITMAPS = 1 << 13

# Place values of an order and a row number, both below 2^63, in one decimal of 38 digits.
_SHIFT = Decimal(10**19)


# Numbers that hashes of keys are reduced to by a sieve: 8 MB of bitmaps at most.
SIEVE_BITS = 1 << 26


def winning_rows(
    rows: DataFrame, keys: list[str], order: Column | None = None, count: str | None = None, among: DataFrame | None = None
) -> DataFrame:
    """Of each key the row with the smallest ``order``, a whole number not below 0, or any row.

    The rows are written once, with a number each. The winner of a key is found from
    key, order and number alone, in fixed-width buffers that combine inside each
    task: no wide column is sorted or carried along. The winners' rows are picked by
    their numbers where they lie (:func:`rows_at`), so a key with very many rows stays
    spread. A null order comes last. ``count`` adds how many rows a key had. ``among``
    holds the keys that may have a winner; only keys are looked up in it.
    """
    held = rows.withColumn("_order", F.coalesce(order.cast("long"), F.lit((1 << 63) - 1)) if order is not None else F.lit(0).cast("long"))
    held = stage(held.withColumn("_at", F.monotonically_increasing_id()), work_dir(rows.sparkSession, "winners"))
    packed = F.col("_order").cast("decimal(38,0)") * F.lit(_SHIFT) + F.col("_at").cast("decimal(19,0)")
    counts = [F.count(F.lit(1)).alias(count)] if count else []
    best = held.groupBy(*keys).agg(F.min(packed).alias("_best"), *counts)
    if among is not None:
        best = best.join(among.select(*keys).distinct(), keys, "left_semi")
    places = best.select((F.col("_best") % F.lit(_SHIFT)).cast("long").alias("_at"), *([count] if count else []))
    won = rows_at(held, places, "_at")
    return (won.join(places, "_at") if count else won).drop("_at", "_order")


def rows_at(rows: DataFrame, places: DataFrame, at: str, *within: str) -> DataFrame:
    """The rows of a written table whose number ``at`` is among ``places``; no row moves for it.

    The numbers count the rows of each task, or of each file that ``within`` names, so
    they lie close together: a bit for each goes to all tasks, as bitmaps of 4 KB. Where
    these are too many the rows are joined with their numbers.
    """
    number = F.col(at) + 1
    bits = places.groupBy(*within, F.bitmap_bucket_number(number).alias("_block"))
    bits = stage(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")), work_dir(rows.sparkSession, "bitmaps"))
    if bits.count() > MOST_BITMAPS:
        return rows.join(places.select(*within, at), [*within, at], "left_semi")
    position = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substr("_bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumn("_block", F.bitmap_bucket_number(number)).join(F.broadcast(bits), [*within, "_block"])
    return marked.where(F.getbit(byte, (position % 8).cast("int")) == 1).drop("_block", "_bits")


def sifted(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose key is not in ``lookup``; no row moves for it.

    A key in ``lookup`` always stays, another one only where its hash meets one of
    theirs: whoever needs to know looks the rest up.
    """
    place = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS)).alias("_sieve")
    return rows_at(rows.select("*", place), lookup.select(place), "_sieve").drop("_sieve")
