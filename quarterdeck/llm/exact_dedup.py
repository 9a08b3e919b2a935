"""Exact dedup by skew-safe combining.

Copies are merged three times, each time by digest *and* full normalised text: within a scan task (the map side
of the first aggregation), within a salt of a digest group, and across the salts. A group that holds a third of
all rows reaches each step as at most one row per task or salt. What is aggregated is one number per row that
orders the rows of a group, so Spark keeps to hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import staged

WHITE = r"[\x20\x09-\x0D]+"
_SPAN = 2**65  # above any code of a doc_id


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def _rank_code(chars: Column, doc_id: Column) -> Column:
    """The more characters and the smaller the doc_id, the larger; a null doc_id is behind all others."""
    wide = "decimal(20,0)"
    behind = F.coalesce((_number(2**63) - doc_id.cast(wide)).cast(wide), _number(0))
    return (chars.cast("decimal(12,0)") * _number(_SPAN) + behind).cast("decimal(38,0)")


def _doc_of(code: Column) -> Column:
    behind = (code % _number(_SPAN)).cast("decimal(20,0)")
    return F.when(behind > 0, (_number(2**63) - behind).cast("long"))


def exact_dedup(docs: DataFrame, salts: int = 16, digest=lambda text: F.sha2(text, 256)) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after white space (``WHITE``) is deleted. Of equal texts the row with
    the most code points stays, then the smallest doc_id.

    Nulls and ties: a null text counts as empty, and all empty texts are one group. Among texts of one length a row
    without doc_id comes last; where such a row stays, keep_id is null. Rows that repeat a doc_id with an equal text are one
    document and share ``kept``; group_size counts them all. Other columns are not read; an empty table gives
    an empty result. ``digest`` may collide: groups are told apart by their whole texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).alias("chars"), F.regexp_replace(text, WHITE, "").alias("body"))
        .withColumn("digest", digest(F.col("body")))
        .withColumn("code", _rank_code(F.col("chars"), F.col("doc_id")))
    )
    salted = (
        rows.select("digest", "body", "code", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
        .groupBy("digest", "salt", "body")
        .agg(F.max("code").alias("code"), F.count(F.lit(1)).alias("n"))
    )
    groups = salted.groupBy("digest", "body").agg(F.max("code").alias("code"), F.sum("n").alias("group_size"))
    # The text stays behind here; a group's name is two digests of it.
    groups = staged(
        groups.select(F.sha2("body", 256).alias("text_sha256"), F.md5("body").alias("text_md5"), _doc_of(F.col("code")).alias("keep_id"), "group_size"),
        "exact-groups",
    )
    # Plain equi-join of narrow rows: Spark splits the partition of a hot group by itself.
    named = rows.select("doc_id", F.sha2("body", 256).alias("text_sha256"), F.md5("body").alias("text_md5"))
    return named.join(groups, ["text_sha256", "text_md5"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
