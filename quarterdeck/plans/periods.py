"""Year-quarter periods."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import quarter_label, year_quarter
from ..functions.urls import path_of
from ..operators.keys import not_done
from ..schemas import FIRST_PERIOD, FIRST_YEAR, INDEX_FILE, INDEX_ROOT


def default_bounds(as_of: date) -> tuple[float, float]:
    """First known period, and the last complete quarter before ``as_of`` (YYYY.0 stands for the year's end)."""
    return FIRST_PERIOD, float(f"{as_of.year}.{(as_of.month - 1) // 3}")


def grid_between(bounds: DataFrame) -> DataFrame:
    """All periods whose number (2020.1 to 2020.4) lies between ``from`` and ``to``: one row of bounds in, one per quarter out.

    Bounds need not be numbers of quarters: 2001.0 stands before the year's first quarter, 2001.5 behind its last.
    """
    first, last = F.greatest(F.floor("from"), F.lit(FIRST_YEAR)).cast("int"), F.floor("to").cast("int")
    years = bounds.select("from", "to", F.explode(F.when(first <= last, F.sequence(first, last))).alias("Year"))
    pairs = years.select("from", "to", "Year", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("Quarter"))
    numbered = pairs.withColumn("YearQuarter", year_quarter(F.col("Year"), F.col("Quarter")))
    return numbered.filter(F.col("YearQuarter").between(F.col("from"), F.col("to"))).select(
        "Year", "Quarter", "YearQuarter", quarter_label(F.col("Year"), F.col("Quarter")).alias("YearQtrSave")
    )


def period_grid(
    spark: SparkSession, as_of: date, from_: float | None = None, to: float | None = None
) -> DataFrame:
    """All periods of a range; the defaults are all complete quarters as of a day."""
    low, high = default_bounds(as_of)
    low = low if from_ is None else float(from_)
    high = high if to is None else min(float(to), float(f"{as_of.year}.4"))
    return grid_between(spark.createDataFrame([(low, high)], "`from` double, `to` double"))


def period_bounds(filings: DataFrame) -> DataFrame:
    """First and last period of a table, as ``from`` and ``to``."""
    return filings.agg(F.min("YearQuarter").alias("from"), F.max("YearQuarter").alias("to"))


def add_sources(grid: DataFrame, out_dir: str) -> DataFrame:
    """Address of each period's index file, and the path its table is written to."""
    folder = F.concat(F.lit("QTR"), F.col("Quarter").cast("string"))
    return grid.select(
        "*",
        path_of(INDEX_ROOT, F.col("Year").cast("string"), folder, INDEX_FILE).alias("UrlMasterIndex"),
        path_of(out_dir, F.concat(F.col("YearQtrSave"), F.lit(".parquet"))).alias("PathOut"),
    )


def pending_periods(grid: DataFrame, done: DataFrame) -> DataFrame:
    """Periods of which the output holds nothing yet."""
    return not_done(grid, done.select("YearQtrSave").distinct(), ["YearQtrSave"])
