"""Keeping expensive expressions and inputs from being computed twice."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps use or filter by.

    Spark pushes a filter on a computed column below the projection, and so computes it twice. Columns that come
    out of a generator (here with one row each) stay behind it and are computed once.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("__once")
    return df.select("*", packed).select(*df.columns, *[F.col(f"__once.{name}").alias(name) for name in columns])


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the writes meanwhile."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """What is shuffled for a table written meanwhile goes once it is written, not when the driver collects its garbage."""
    return setting(spark, _SHUFFLE_CLEANUP, "true")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a new shared folder and read it back: for inputs that several outputs are made from."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(staged_: DataFrame) -> None:
    """Delete a staged table: all that was made from it is written."""
    for folder in {file.rsplit("/", 1)[0] for file in staged_.inputFiles()}:
        delete(staged_.sparkSession, folder)
