"""The corpus pipeline: documents in, packed training windows out.

Each stage calls one operator of ``quarterdeck.llm`` on all that the stage before it kept. Its result is written and read again,
so a stage is computed once and survives lost executors. What a stage left in the shared folder goes when the next one starts.

Nulls, empty texts, ties, repeated rows and empty tables: each stage takes them as its operator states; an empty table stays empty.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import line_dedup, packing, paragraphs, simhash, toxicity
from quarterdeck.llm.common import freeing, staged, table


@freeing
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects by the threshold of their language go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@freeing
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal lines and lines one edit apart, the earliest stays in its document."""
    return line_dedup.drop_repeated_lines(docs)


@freeing
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the one with the smallest doc_id stays."""
    return simhash.keep_one(docs)


@freeing
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of repeated paragraphs and sentences, the earliest stays in its document."""
    return paragraphs.drop_repeats(docs)


@partial(freeing, last=True)
def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids in windows of 2048, filled with lexical neighbours; one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_windows),
]

#: No SQL: training, fingerprints, retrieval and tokenization cannot be written in it. tests/llm holds each stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
