"""Raw files: listing and reading."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import base_name
from .landed import landed_files


def file_ids(paths: DataFrame, regex: str | None = None, path: str = "path") -> DataFrame:
    """(doc_id, path) of the files whose name matches; the id is the name without its extension."""
    if regex is not None:
        paths = paths.filter(F.regexp_extract(F.col(path), r"([^/]*)$", 1).rlike(regex))
    return paths.select(base_name(F.col(path)).alias("doc_id"), F.col(path).alias("path"))


def list_files(
    spark: SparkSession, dirs: str | Sequence[str], regex: str | None = None, recursive: bool = False
) -> DataFrame:
    """List files, in tasks: the driver holds the folders right below ``dirs`` at most, and no file is opened."""
    return file_ids(landed_files(spark, dirs, int(recursive), recursive).select("path"), regex)


def read_files(spark: SparkSession, dirs: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """Raw files as (path, modificationTime, length, content)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return reader.load([dirs] if isinstance(dirs, str) else list(dirs))


def decode_text(content: Column, encoding: str = "UTF-8") -> Column:
    """Bytes to text. Broken UTF-8 becomes U+FFFD and the row survives.

    In other encodings bytes that stand for nothing give null: Spark's decoder would end the job. ASCII and Latin-1, of
    which that can be told by a pattern, are decoded where they are sound; any other encoding is left to Python.
    """
    name = encoding.upper().replace("_", "-")
    if name in ("UTF-8", "UTF8"):
        return F.make_valid_utf8(content.cast("string"))
    if name in ("US-ASCII", "ASCII"):
        return F.when(~F.hex(content).rlike("^(?:..)*[89A-F]."), F.decode(content, "US-ASCII"))
    if name in ("ISO-8859-1", "LATIN-1", "LATIN1"):
        return F.decode(content, "ISO-8859-1")

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        def text(value: bytes | None) -> str | None:
            try:
                return None if value is None else value.decode(encoding)
            except UnicodeDecodeError:
                return None

        return values.map(text)

    return decode(content)
