"""Partitioned Parquet tables: first write, new partitions only, and merge with existing rows winning."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keys import keep_first, not_done
from ..operators.stages import delete, setting, shuffles_freed, staged
from ..session import shared_dir

QUARTER = "YearQtr"
FILE_BYTES = 64 << 20  # about so many in a file of a merged table
# Would run the single tasks of all quarters as one.
_UNION = "spark.sql.unionOutputPartitioning"


def read_if_exists(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table, or None; with a schema no file is opened to tell its columns."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def balance(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Gather the rows of a partition and, at run time, split the large ones.

    A quarter with a third of all rows becomes many files of a sound size, a small one a single file.
    """
    return df.hint("rebalance", *by)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "append",
    compression: str = "zstd",
    balanced: bool = True,
) -> None:
    """Write by partition columns; ``balanced=False`` for rows that were balanced before."""
    rows = balance(df, by) if balanced else df
    with shuffles_freed(df.sparkSession):
        rows.write.mode(mode).option("compression", compression).partitionBy(*by).parquet(path)


def done_path(path: str) -> str:
    """Where the names of a table's finished partitions are kept."""
    return f"{path.rstrip('/')}.done"


def write_new_partitions(spark: SparkSession, df: DataFrame, path: str, by: str = QUARTER) -> None:
    """Write the partitions that were not finished before.

    A partition's name is noted after its files are written, so one that a failed run left half-written isn't taken for
    finished: it is replaced as a whole. Names are few (one for each quarter of the calendar).
    """
    done = read_if_exists(spark, done_path(path))
    if done is not None:
        df = not_done(df, done, [by])
    rows = staged(balance(df, [by]), "partitions")
    names = rows.select(by).distinct()
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(by).parquet(path)
    names.coalesce(1).write.mode("append").parquet(done_path(path))


def merge_new(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column | str],
    by: str = QUARTER,
    observed: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    quarters: Sequence[str] | None = None,
) -> None:
    """Merge rows into a table; of equal keys the existing row wins, then the first new one.

    ``observed`` gets the rows that are added as they are written, to attach an ``Observation`` to them. ``quarters`` are those that
    ``new`` can fall in; if they are not given, ``new`` is first worked out for them alone, and of the table only these are read.

    Since existing rows never change, the merge is an append of the rows whose key is new. No quarter is rewritten, and
    a run repeated after a failure adds nothing twice. Rows move once: the keys of the table meet the new rows where the first of
    each key is found. What is added is staged by quarter and put together from there into files of a sound size.
    """
    existing = read_if_exists(spark, path)
    if existing is not None:
        found = touched(existing, new, by) if quarters is None else existing.filter(F.col(by).isin(list(quarters)))
        rows = first_unknown(new, found, [by, *keys], order)
    else:
        rows = keep_first(new, [by, *keys], order)
    folder = shared_dir(spark, "merge")
    write_partitioned(rows, folder, [by], balanced=False)
    kept = spark.read.schema(rows.schema).parquet(folder)
    with setting(spark, _UNION, "false"):
        write_partitioned(observed(_gathered(kept, by)), path, [by], balanced=False)
    delete(spark, folder)


def first_unknown(new: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first of the ``new`` rows of each key that ``existing`` lacks; null keys equal none of ``existing``.

    A known key comes before the new rows of that key, so one shuffle settles both.
    """
    types = dict(new.dtypes)
    known = existing.dropna(subset=list(keys)).select(
        *[F.col(c).cast(t).alias(c) if c in keys else F.lit(None).cast(t).alias(c) for c, t in types.items()], F.lit(False).alias("__new")
    )
    first = keep_first(new.withColumn("__new", F.lit(True)).unionByName(known), keys, ["__new", *order])
    return first.filter("__new").drop("__new")


def _gathered(staged_: DataFrame, by: str) -> DataFrame:
    """A table staged by quarter, dealt out so that a task holds rows of one quarter, as many as make a file of a sound size."""
    files = staged_.select(by, "_metadata.file_path", "_metadata.file_size").distinct()
    sizes = files.groupBy(by).agg(F.sum("file_size").alias("bytes")).collect()
    parts = [staged_.filter(F.col(by).eqNullSafe(F.lit(r[by]))).coalesce(max(-(-r.bytes // FILE_BYTES), 1)) for r in sizes]
    return reduce(DataFrame.unionAll, parts) if parts else staged_


def touched(existing: DataFrame, rows: DataFrame, by: str = QUARTER) -> DataFrame:
    """The partitions of a table that ``rows`` fall in; the filter reaches the scan."""
    quarters = [r[0] for r in rows.select(by).distinct().collect()]
    return existing.filter(F.col(by).isin(quarters))


def append_run_log(rows: DataFrame, path: str) -> None:
    """Append log rows as quoted CSV files."""
    rows.write.mode("append").option("header", True).option("quoteAll", True).option("nullValue", "NA").csv(path)
