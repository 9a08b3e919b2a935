"""Distinct, first-per-key, membership and pending-work operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Written as row number 1: Spark then drops the later rows of a key before the shuffle, so a key with very
    many copies does not travel to one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def only_ids(df: DataFrame, column: str, ids: DataFrame | Sequence[str] | None) -> DataFrame:
    """Rows whose id is wanted; None keeps all.

    A list becomes a filter that reaches the scan, a table is semi-joined: pass ids that are many as a table.
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))


def not_done(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``done``; an anti join, so nulls in ``done`` change nothing."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def marked(rows: DataFrame, number: str) -> DataFrame:
    """The row numbers of ``rows`` as bitmaps, at one bit a number: bucket and bits, for ``only_marked``."""
    place = F.bitmap_bit_position(F.col(number))
    return rows.groupBy(F.bitmap_bucket_number(F.col(number)).alias("__bucket")).agg(F.bitmap_construct_agg(place).alias("__bits"))


def only_marked(df: DataFrame, marks: DataFrame, number: str) -> DataFrame:
    """Rows of ``df`` whose number is marked; the bitmaps are broadcast, so that wide rows stay where they lie."""
    place = F.bitmap_bit_position(F.col(number)).cast("int")
    byte = F.conv(F.hex(F.substr(F.col("__bits"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftleft", F.lit(1), place.bitwiseAND(7))
    both = df.withColumn("__bucket", F.bitmap_bucket_number(F.col(number))).join(F.broadcast(marks), "__bucket")
    return both.filter(byte.bitwiseAND(bit) != 0).select(*df.columns)
