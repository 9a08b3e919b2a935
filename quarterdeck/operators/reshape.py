"""Unions, pivots and nested groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import number_rows


def union_sources(sources: dict[str, DataFrame], id_column: str | None = None) -> DataFrame:
    """Stack tables by column name, missing columns as null; ``id_column`` names the source of a row."""
    named = [df.withColumn(id_column, F.lit(name)) if id_column else df for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def pivot_attributes(
    df: DataFrame,
    keys: Sequence[str],
    known: Sequence[str],
    order: Column,
    name: str = "Name",
    info: str = "Info",
    other: str = "Other",
) -> DataFrame:
    """Long attributes to one column per known name; the rest go to the map ``other``.

    The list of columns is fixed so that the schema does not depend on the data. Of a repeated name the first
    value counts.
    """
    first = df.groupBy(*keys, name).agg(F.min_by(info, order).alias(info))
    extra = ~F.col(name).isin(list(known))
    values = [F.max(F.when(F.col(name) == n, F.col(info))).alias(n) for n in known]
    pairs = F.sort_array(F.collect_list(F.when(extra, F.struct(F.col(name), F.col(info)))))
    return first.groupBy(*keys).agg(*values, F.map_from_entries(pairs).alias(other))


def nest_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bucket: Column,
    columns: Sequence[str],
    name: str = "Rows",
    chunk_rows: int = 1000,
) -> DataFrame:
    """Nest the rows of each group as arrays of structs, in chunks of bounded size (numbered from 1)."""
    numbered = number_rows(df, keys, order, bucket, "__row")
    chunked = numbered.withColumn("Chunk", F.ceil(F.col("__row") / chunk_rows))
    packed = F.sort_array(F.collect_list(F.struct("__row", *columns)))
    rows = F.transform(packed, lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return chunked.groupBy(*keys, "Chunk").agg(rows.alias(name))
