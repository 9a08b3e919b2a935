"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Steps that send whole pages to Python: small batches, on top of Spark's own limit in bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app: str = "quarterdeck", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder (a scratch folder if none is set)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="quarterdeck-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
