"""Incremental ingest of newly landed files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import QUARTER, merge_new


def ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[Column | str],
    by: str = QUARTER,
    files_per_batch: int | None = None,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Merge the files that landed since the last run into a table, then stop.

    Each micro-batch is merged by key with existing rows winning, so a batch repeated after a failure adds
    nothing. ``files_per_batch`` bounds the size of a batch.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, _: int) -> None:
        merge_new(batch.sparkSession, transform(batch), target, keys, order, by)

    query = (
        reader.load(source)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
