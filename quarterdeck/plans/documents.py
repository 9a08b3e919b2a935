"""Documents: selection, parsing and storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import trim_blanks
from ..functions.html import add_html_text
from ..functions.ids import label_from_number
from ..functions.text import StandardizeOptions, standardize_text
from ..functions.urls import HTML_EXTENSIONS, TEXT_EXTENSIONS, base_name, file_extension, path_of, type_label, unwrap_viewer
from ..operators.keys import keep_first, not_done, only_ids
from ..operators.ordered import hash_bucket, number_rows
from ..operators.quality import log_rows
from ..operators.reshape import nest_groups
from ..operators.stages import staged
from ..schemas import PARSED_DOCUMENT
from ..sinks.processed import extend_filter, pending
from ..sinks.tables import append_run_log, read_if_exists, write_partitioned
from ..sources.files import decode_text
from ..sources.landed import landed_files, open_files

GROUP = ["TypeSave", "YQSave"]
TASK_BYTES, LEAST_BYTES = 16 << 20, 1 << 20  # of landed files that a task parses, and below which dealing them out further does not pay
TASKS_PER_CORE = 3
PARSED = "Parsed Documents: "  # text of the log


def docs_by_type(links: DataFrame, types: DataFrame, ids: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Wanted documents with their modified type, labels, extension and paths; unknown types drop out."""
    raw = only_ids(links, "DocID", ids).select("YearQuarter", F.col("Type").alias("DocTypeRaw"), "DocID", "UrlDocument")
    # Pass the saved lookup: its file's size lets Spark broadcast it, where counted types would shuffle all links by type.
    typed = raw.join(types.select("DocTypeRaw", "DocTypeMod"), "DocTypeRaw")
    named = typed.select(
        "YearQuarter",
        "DocTypeMod",
        "DocID",
        "UrlDocument",
        label_from_number(F.col("YearQuarter")).alias("YQSave"),
        type_label(F.col("DocTypeMod")).alias("TypeSave"),
        file_extension(F.col("UrlDocument")).alias("DocExt"),
    ).filter(F.col("DocExt") != "")
    return named.select(
        "YearQuarter",
        "DocTypeMod",
        "DocID",
        unwrap_viewer(F.col("UrlDocument")).alias("UrlDocument"),
        "YQSave",
        "TypeSave",
        "DocExt",
        path_of("Original", F.col("TypeSave"), F.col("YQSave"), F.concat("DocID", F.lit("."), "DocExt")).alias("PathOrig"),
        path_of("Parsed", F.col("TypeSave"), F.col("YQSave"), F.concat("DocID", F.lit(".parquet"))).alias("PathParse"),
    )


def pending_documents(
    links: DataFrame, types: DataFrame, parsed: DataFrame | None, ids: DataFrame | Sequence[str] | None = None
) -> DataFrame:
    """Documents not parsed yet, once per output (type, quarter, DocID)."""
    docs = docs_by_type(links, types, ids)
    if parsed is not None:
        docs = not_done(docs, parsed, [*GROUP, "DocID"])
    return keep_first(docs, [*GROUP, "DocID"], ["DocTypeMod", "YearQuarter", "UrlDocument", "DocExt"])


def _digest_part(doc_id: str = "DocID"):
    return F.substring_index(F.col(doc_id), "-", -1)


def group_progress(docs: DataFrame, digits: int = 3) -> DataFrame:
    """Position and size of each document's group, and the line to report it with; ``digits`` as in ``hash_bucket``.

    The documents are staged: buckets are counted before rows are numbered, and each would find them anew.
    """
    order = [_digest_part(), F.col("DocID")]
    counted = number_rows(staged(docs, "numbered"), GROUP, order, hash_bucket(_digest_part(), digits), "nRow", "nAll")
    # Counters with thousands separators.
    row, total = (F.format_number(c, 0) for c in ("nRow", "nAll"))
    shown = F.concat(F.col("TypeSave"), F.lit(": "), F.col("YQSave"), F.lit(" ("), row, F.lit("/"), total, F.lit(")"))
    return counted.withColumn("Print", shown)


def nest_documents(docs: DataFrame, columns: Sequence[str] = ("DocID", "UrlDocument"), chunk_rows: int = 1000, digits: int = 3) -> DataFrame:
    """Documents nested by type and quarter, in chunks of bounded size; ``digits`` as in ``hash_bucket``. Staged as in ``group_progress``."""
    order = [_digest_part(), F.col("DocID")]
    return nest_groups(staged(docs.select(*GROUP, *dict.fromkeys(["DocID", *columns])), "nested"), GROUP, order, hash_bucket(_digest_part(), digits), columns, "Documents", chunk_rows)


def parse_documents(
    files: DataFrame, options: StandardizeOptions = StandardizeOptions(), encoding: str = "UTF-8"
) -> DataFrame:
    """Raw files (path, content) to source, raw text and standardized text; one map-only pass in the JVM.

    Files that are unsupported or cannot be decoded, and pages without any text, give an error row.
    """
    ext = file_extension(F.col("path"))
    named = files.select(
        *[c for c in files.columns if c != "content"],
        base_name(F.col("path")).alias("DocID"),
        ext.alias("DocExt"),
        F.when(ext.isin(TEXT_EXTENSIONS), decode_text(F.col("content"), encoding)).alias("HTML"),
    )
    is_page = F.col("DocExt").isin(HTML_EXTENSIONS)
    paged = add_html_text(named.withColumn("__page", F.when(is_page, F.col("HTML"))), "__page", "__shown")
    read = paged.withColumn("TextRaw", F.when(is_page, F.col("__shown")).otherwise(F.col("HTML")))
    undecoded = F.lit(f"bytes are not {encoding}")
    message = F.when(
        F.col("HTML").isNull(),
        F.when(F.col("DocExt").isin(TEXT_EXTENSIONS), undecoded).otherwise(F.concat("DocExt", F.lit(" is not supported"))),
    ).when(is_page & (trim_blanks(F.coalesce("TextRaw", F.lit(""))) == "") & (F.col("HTML") != ""), F.lit("no text found"))
    done = read.withColumn("TextMod", standardize_text(F.col("TextRaw"), options)).withColumn("MsgParse", message)
    extra = [c for c in files.columns if c not in ("path", "content")]
    return done.withColumn("ErrParse", F.col("MsgParse").isNotNull()).select(*PARSED_DOCUMENT.fieldNames(), *extra)


def build_documents(
    spark: SparkSession,
    links: DataFrame,
    types: DataFrame,
    raw_dir: str,
    out_dir: str,
    ids: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """Parse the landed files of pending documents and append them by type and quarter; returns that table.

    Files lie below ``raw_dir`` in the folders of ``PathOrig`` (Original/type/quarter). Only the folders of pending documents are
    listed, in tasks, and only their files are opened, by the task that parses them; large groups are dealt out to
    tasks by size. So no byte is shuffled, and parsed rows, which hold a text three times, are written where they
    come up. The log notes what a run opened.
    """
    path = f"{out_dir}/Parsed"
    pending_docs = staged(pending(spark, pending_documents(links, types, None, ids), path, GROUP, ["DocID"]), "pending-documents")
    # As many folders as there are types and quarters with pending documents.
    groups = pending_docs.select(*GROUP).distinct().collect()
    if groups:
        roots = ["/".join([raw_dir.rstrip("/"), "Original", g.TypeSave, g.YQSave]) for g in groups]
        listed = landed_files(spark, roots, depth=0).select("path", "length").withColumns(_file_keys())
        wanted = listed.join(pending_docs.select(*GROUP, "DocID", "DocExt"), [*GROUP, "DocID", "DocExt"])
        wanted = staged(wanted, "wanted-files")
        if not wanted.isEmpty():
            _parse_files(spark, wanted, path, f"{out_dir}/Log")
    built = read_if_exists(spark, path)
    return built if built is not None else spark.createDataFrame([], _PARSED)


def dealt_by_size(files: DataFrame, by: Sequence[str], task_bytes: int = TASK_BYTES) -> DataFrame:
    """Files (path, length and ``by``) dealt out so that a task has about ``task_bytes`` of them, of one group if it is large.

    Less than that where a run is too small to give every core a few tasks, since tasks get uneven shares.
    """
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    even = total // (files.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE)
    share = min(task_bytes, max(even, LEAST_BYTES))
    parts = F.greatest(F.ceil(F.sum("length") / share), F.lit(1)).cast("int")
    sizes = files.groupBy(*by).agg(parts.alias("__parts"))
    # Small groups share a task.
    tasks = -(-total // share)
    part = F.pmod(F.xxhash64("path"), F.col("__parts"))
    return files.join(sizes, list(by)).withColumn("__part", part).repartition(max(tasks, 1), *by, "__part").drop("__part", "__parts")


def _parse_files(spark: SparkSession, wanted: DataFrame, path: str, log: str) -> None:
    opened, seen = open_files(dealt_by_size(wanted.select("path", "length", *GROUP), GROUP)), Observation()
    parsed = parse_documents(opened.drop("length"))
    counts = F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("ErrParse").cast("int")), F.lit(0)).alias("errors")
    extend_filter(spark, wanted, path, GROUP, ["DocID"])
    write_partitioned(parsed.observe(seen, *counts), path, GROUP, compression="gzip", balanced=False)
    run = spark.createDataFrame([(seen.get["n"], seen.get["errors"])], "n long, errors long")
    details = F.concat(F.lit("Errors: "), F.col("errors").cast("string"))
    append_run_log(log_rows(run, F.current_timestamp(), "INFO", F.concat(F.lit(PARSED), F.col("n").cast("string")), details), log)


_PARSED = T.StructType([*PARSED_DOCUMENT.fields, *[T.StructField(c, T.StringType()) for c in GROUP]])


def _file_keys() -> dict[str, Column]:
    """Group, id and extension of a landed file, from its path."""
    folder = r"/Original/([^/]+)/([^/]+)/[^/]*$"
    return {
        "TypeSave": F.regexp_extract("path", folder, 1),
        "YQSave": F.regexp_extract("path", folder, 2),
        "DocID": base_name(F.col("path")),
        "DocExt": file_extension(F.col("path")),
    }
