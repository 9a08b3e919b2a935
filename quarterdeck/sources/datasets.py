"""Parquet tables of the pipeline and filtered reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import only_ids
from ..schemas import FIRST_PERIOD
from ..sinks.tables import QUARTER


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A Parquet file, or a folder of them."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def _label(period: float) -> str:
    """A period's bound as text that compares with quarter labels as the period does with their numbers."""
    year = int(period)
    return f"{year:04}-{round(10 * (period - year), 6):g}"


def in_partitions(from_: float | None, to: float | None) -> Column:
    """The quarter labels (partition values) of a period."""
    low = F.col(QUARTER) >= F.lit(_label(FIRST_PERIOD if from_ is None else from_))
    return low if to is None else low & (F.col(QUARTER) <= F.lit(_label(to)))


def select_filings(
    filings: DataFrame,
    from_: float | None = None,
    to: float | None = None,
    ciks: Sequence[str] | DataFrame | None = None,
    form_types: Sequence[str] | None = None,
    doc_types: DataFrame | None = None,
) -> DataFrame:
    """Filter a filings or links table by period, filer, form type and raw document type.

    A table that is partitioned by quarter is read in the quarters of the period only.
    """
    if QUARTER in filings.columns and (from_ is not None or to is not None):
        filings = filings.filter(in_partitions(from_, to))
    if from_ is not None or to is not None:
        low = F.lit(FIRST_PERIOD if from_ is None else from_)
        period = F.col("YearQuarter") >= low
        filings = filings.filter(period if to is None else period & (F.col("YearQuarter") <= F.lit(to)))
    filings = only_ids(filings, "CIK", ciks)
    filings = only_ids(filings, "FormType", form_types)
    return filings if doc_types is None else only_ids(filings, "Type", doc_types)


def read_filings(spark: SparkSession, path: str, **filters) -> DataFrame:
    """Master index rows of a period, filers and form types."""
    return select_filings(read_table(spark, path), **filters)


def read_links(
    spark: SparkSession, path: str, index_path: str | None = None, form_types: Sequence[str] | None = None, **filters
) -> DataFrame:
    """Document links of a period, filers and document types; form types are looked up in the index."""
    links = select_filings(read_table(spark, path), **filters)
    if form_types is None:
        return links
    if index_path is None:
        raise ValueError("filtering links by form type needs the master index")
    wanted = select_filings(read_table(spark, index_path), form_types=form_types).select("HashIndex")
    return links.join(wanted, "HashIndex", "left_semi")
