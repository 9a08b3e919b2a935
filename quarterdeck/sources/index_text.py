"""Pipe-delimited quarterly index files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import digest_id, pad_cik, parse_date, year_quarter
from ..functions.urls import index_page_url, url_absolute
from ..schemas import ARCHIVE_BASE, INDEX_HEADER

FIELDS = ["CIK", "CompanyName", "FormType", "DateFiled", "Filename"]


@dataclass(frozen=True)
class ParsedIndex:
    filings: DataFrame
    quarantine: DataFrame


def read_index_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of index files as (file, value). Text files are split, so one large file is many tasks."""
    lines = spark.read.option("recursiveFileLookup", "true").text([paths] if isinstance(paths, str) else list(paths))
    return lines.select(F.col("_metadata.file_path").alias("file"), "value")


def _header_pattern() -> str:
    """The header line, whatever its spacing and case; data lines fail at their first character."""
    gap = "[^a-z0-9|]*"
    names = [gap + gap.join(name.lower().split()) + gap for name in INDEX_HEADER]
    return "(?i)^" + r"\|".join(names) + "$"


def file_period(file: Column) -> tuple[Column, Column]:
    """Year and quarter of an index file, from its path."""
    pattern = r"/([0-9]{4})/QTR([1-4])/[^/]*$"
    parts = (F.nullif(F.regexp_extract(file, pattern, group), F.lit("")).cast("int") for group in (1, 2))
    return tuple(parts)


def parse_index(lines: DataFrame) -> ParsedIndex:
    """Index lines to typed filings, and the lines set aside with a reason.

    A file counts when it has the expected header. Preamble and rule lines hold no pipe and are dropped; a
    line with another number of fields is set aside alone, not with its whole quarter.
    """
    is_header = F.col("value").rlike(_header_pattern())
    rows = lines.filter(F.col("value").contains("|")).select("file", "value", is_header.alias("h"))

    # One row per file; joining it back needs no shuffle of the lines while it is small.
    good = rows.filter("h").select("file").distinct().withColumn("ok", F.lit(True))
    fields = F.split("value", r"\|")
    data = rows.filter(~F.col("h")).join(good, "file", "left").select("file", "value", "ok", fields.alias("f"))
    reason = F.when(F.col("ok").isNull(), F.lit("Unexpected Header")).when(
        F.size("f") != len(FIELDS), F.lit("Unexpected Number of Fields")
    )
    marked = data.withColumn("Reason", reason)

    year, quarter = file_period(F.col("file"))
    flat = marked.filter(F.col("Reason").isNull()).select(
        year.alias("Year"), quarter.alias("Quarter"), *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(FIELDS)]
    )
    return ParsedIndex(add_filing_ids(flat), marked.filter(F.col("Reason").isNotNull()).select("file", "value", "Reason"))


def add_filing_ids(flat: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw fields with Year and Quarter to master index rows; ``keep`` names further columns to carry along."""
    full = flat.withColumn("UrlFullText", url_absolute(F.col("Filename"), ARCHIVE_BASE))
    paged = full.withColumn("UrlIndexPage", index_page_url(F.col("UrlFullText")))
    return paged.select(
        digest_id(F.col("UrlIndexPage")).alias("HashIndex"),
        "Year",
        "Quarter",
        year_quarter(F.col("Year"), F.col("Quarter")).alias("YearQuarter"),
        pad_cik(F.col("CIK")).alias("CIK"),
        "CompanyName",
        "FormType",
        parse_date(F.col("DateFiled")).alias("DateFiled"),
        "UrlFullText",
        "UrlIndexPage",
        *keep,
    )
