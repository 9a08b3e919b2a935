"""Ordered work inside groups when one group may hold a large share of all rows.

A plain window sends each group to one task. Here the group is cut into buckets that follow the order, every
bucket is handled on its own, and a small table with one row per (group, bucket) carries the totals over. The
results are those of the plain window.

``bucket`` must not decrease along ``order`` (a prefix of a hash the rows are ordered by, the hour of a time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# Keys and bucket travel as one struct: it is never null, so null keys join by plain equality and the
# window after the join finds the rows already partitioned.
_GROUP = "__group"


def _cut(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """The rows dealt out by group and bucket, once: totals, join and window all find them in place."""
    return df.withColumn(_GROUP, F.struct(*keys, bucket.alias("__bucket"))).repartition(_GROUP)


def _across(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*[F.col(f"{_GROUP}.`{k}`") for k in keys])


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bucket: Column,
    name: str = "RowNum",
    total: str | None = None,
) -> DataFrame:
    """Number the rows of each group from 1; ``total`` adds the size of the group."""
    cut = _cut(df, keys, bucket)
    counts = cut.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("__n"))
    earlier = _across(keys).orderBy(f"{_GROUP}.__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(
        _GROUP,
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        *([F.sum("__n").over(_across(keys)).alias(total)] if total else []),
    )
    inside = Window.partitionBy(_GROUP).orderBy(*order)
    numbered = cut.join(carried, _GROUP).withColumn(name, F.col("__before") + F.row_number().over(inside))
    return numbered.select(*df.columns, name, *([total] if total else []))


def fill_down(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, columns: Sequence[str]
) -> DataFrame:
    """Replace nulls by the last value before them in the group."""
    cut = _cut(df, keys, bucket)
    position = F.struct(*order)
    last = cut.groupBy(_GROUP).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"__l_{c}") for c in columns]
    )
    earlier = _across(keys).orderBy(f"{_GROUP}.__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        _GROUP, *[F.last(f"__l_{c}", ignorenulls=True).over(earlier).alias(f"__c_{c}") for c in columns]
    )
    inside = Window.partitionBy(_GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def filled(c: str) -> Column:
        return F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__c_{c}")).alias(c)

    return cut.join(carried, _GROUP).select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def hash_bucket(digest: Column, digits: int = 3) -> Column:
    """Bucket for rows ordered by a hex digest: its first digits, so 16**digits even buckets.

    Raise ``digits`` with the data: a bucket is one task's work, so the largest group over 16**digits must fit one.
    """
    return F.substring(digest, 1, digits)
