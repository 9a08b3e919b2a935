"""Shared steps: reading the given tables, tables staged between the parts of a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names the row in the stages of the pipeline.
ROW = "__row"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors reach.

    Only a local session (tests), where driver and executors are one process, may leave the setting out.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Folders of tables staged by this driver that are still there.
_folders: dict[str, SparkSession] = {}


def staged(df: DataFrame, name: str, file_rows: int = 0, batch_rows: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors.

    For rows of some megabytes each: ``file_rows`` bounds the rows of a file, and so what its readers hold at once, and
    ``batch_rows`` those that a Python step gets at once while ``df`` is worked out (0: as the session has it).
    """
    path, conf = shared_folder(df.sparkSession, name), df.sparkSession.conf
    # What was shuffled for the table goes once it is written, not when the driver collects its garbage.
    during = {_SHUFFLE_CLEANUP: "true"} | ({_BATCH_ROWS: str(batch_rows)} if batch_rows else {})
    before = {key: conf.get(key) for key in during}
    for key, value in during.items():
        conf.set(key, value)
    try:
        df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    _folders[path] = df.sparkSession
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _scanned(df: DataFrame) -> set[str]:
    """The folders that ``df`` reads from, without scheme."""
    return {file.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for file in df.inputFiles()}


def discard(*tables: DataFrame) -> None:
    """Delete the folders of staged tables that nothing will read again: all that was made from them is staged too."""
    for table_ in tables:
        for path in [p for p in _folders if p.split(":", 1)[-1].lstrip("/") in _scanned(table_)]:
            _delete(_folders.pop(path), path)


#: Of these, what stages left that have ended.
_left: set[str] = set()


def freeing(stage: Callable[..., DataFrame], last: bool = False) -> Callable[..., DataFrame]:
    """A stage of a pipeline that first deletes what earlier stages staged and its ``docs`` do not read.

    Results are written between stages, so what a stage staged is of no use once the next one starts. What the ``last`` stage
    staged stays, as its result is the caller's to read.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        used = _scanned(docs) if _left else set()
        for path in [p for p in _left if p.split(":", 1)[-1].lstrip("/") not in used]:
            _left.discard(path)
            if path in _folders:
                _delete(_folders.pop(path), path)
        before = set(_folders)
        result = stage(spark, docs, sf_dir)
        if not last:
            _left.update(set(_folders) - before)
        return result

    return run


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``ROW`` that is one row's alone: its doc_id, if no other row has that.

    Rows that share or lack a doc_id get numbers after the largest doc_id. They are told apart, and their texts are judged
    each on its own; of equal texts those under a doc_id of their own come first.
    """
    key = F.col("doc_id").cast("long")
    shared = staged(docs.groupBy(key.alias("doc_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "shared-ids")
    if shared.isEmpty():
        return docs.withColumn(ROW, key)
    rows = staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered-rows")
    base = (rows.agg(F.max(key)).first()[0] or 0) + 1
    marked = rows.withColumn("__id", key).join(shared.select(F.col("doc_id").alias("__id"), F.lit(True).alias("__shared")), "__id", "left")
    own = F.when(F.col("__id").isNull() | F.col("__shared"), F.col(ROW) + F.lit(max(base, 1))).otherwise(F.col("__id"))
    return marked.withColumn(ROW, own).select(*docs.columns, ROW)
