"""Master index: raw text files to a table by quarter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import quarter_label
from ..operators.quality import empty_outputs, log_message, log_rows
from ..operators.keys import not_done
from ..operators.stages import staged
from ..schemas import MASTER_INDEX
from ..sinks.tables import QUARTER, append_run_log, done_path, read_if_exists, write_new_partitions
from ..sources.files import read_files
from ..sources.index_text import file_period, parse_index, read_index_lines
from .periods import pending_periods, period_grid


# Texts of the log.
READ, NO_ROWS, ROWS = "Downloaded Year-Quarter: ", "Empty table", "Rows: "
FOUND, NOTHING_NEW = "Start Reading Index Files: ", "No New Year-Quarters"


def quarter_log(rows_per_quarter: DataFrame, at) -> DataFrame:
    """One log row per quarter: its row count, or an error for an empty one."""
    empty = F.col("nRows") == 0
    return log_rows(
        rows_per_quarter,
        at,
        F.when(empty, F.lit("ERROR")).otherwise(F.lit("INFO")),
        F.when(empty, log_message(F.col("Reason"))).otherwise(
            F.concat(F.lit(READ), F.col("YearQtrSave"))
        ),
        F.when(empty, F.lit(NO_ROWS)).otherwise(F.concat(F.lit(ROWS), F.col("nRows").cast("string"))),
    )


def build_index(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    as_of: date,
    from_: float | None = None,
    to: float | None = None,
) -> DataFrame:
    """Parse the landed index files not handled yet; returns the whole table.

    Rejected lines go to ``out_dir``/Quarantine, the log to ``out_dir``/Log. A file is noted as handled (Files) when all of
    that is written, whether or not it gave rows: it is not read again, and a run that failed is repeated as a whole. A
    quarter is written once; later files of it are noted and left.
    """
    table, handled_path = f"{out_dir}/MasterIndex", f"{out_dir}/Files"
    grid = period_grid(spark, as_of, from_, to)
    finished = read_if_exists(spark, done_path(table))
    if finished is not None:
        grid = pending_periods(grid, finished.withColumnRenamed(QUARTER, "YearQtrSave"))

    # Paths alone; no file is opened before it is known to be wanted. There is one per quarter or a few.
    found = read_files(spark, raw_dir).select(F.col("path").alias("file"))
    found = found.withColumn("YearQtrSave", quarter_label(*file_period(F.col("file"))))
    handled = read_if_exists(spark, handled_path)
    wanted = found.join(grid.select("YearQtrSave"), "YearQtrSave", "left_semi")
    wanted = staged(wanted if handled is None else not_done(wanted, handled, ["file"]), "index-files")
    paths = [r.file for r in wanted.collect()]
    log = f"{out_dir}/Log"
    start = spark.createDataFrame([(len(paths),)], "n int")
    message = F.when(F.col("n") > 0, F.concat(F.lit(FOUND), F.col("n").cast("string"))).otherwise(F.lit(NOTHING_NEW))
    append_run_log(log_rows(start, F.current_timestamp(), "INFO", message), log)
    if paths:
        lines = read_index_lines(spark, paths)
        parsed = parse_index(lines)
        filings = parsed.filings.withColumn(QUARTER, quarter_label(F.col("Year"), F.col("Quarter")))
        write_new_partitions(spark, filings, table)
        parsed.quarantine.write.mode("append").parquet(f"{out_dir}/Quarantine")
        built = _table(spark, table)
        counted = empty_outputs(grid, built.withColumnRenamed(QUARTER, "YearQtrSave"), "YearQtrSave")
        append_run_log(quarter_log(counted, F.current_timestamp()), log)
        wanted.write.mode("append").parquet(handled_path)
    return _table(spark, table)


def _table(spark: SparkSession, path: str) -> DataFrame:
    """The table, or an empty one while no quarter has given a row."""
    built = read_if_exists(spark, path)
    return built if built is not None else spark.createDataFrame([], MASTER_INDEX).withColumn(QUARTER, F.lit(None).cast("string"))
