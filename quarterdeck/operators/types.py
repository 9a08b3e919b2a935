"""Form-type and document-type lookups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The label of a document that has a description in place of a type.
FULL_TEXT_DESCRIPTION = "Complete submission text file"
FULL_TEXT_TYPE = "Full Submission Text File"


@dataclass(frozen=True)
class TypeRule:
    doc_class: str
    regex: str
    doc_type: str
    description: str


def full_text_type(doc_type: Column, description: Column) -> Column:
    return F.when(doc_type.isNull() & (description == FULL_TEXT_DESCRIPTION), F.lit(FULL_TEXT_TYPE)).otherwise(doc_type)


def count_types(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("nDocs"))


def form_types_raw(counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Counted form types with class, modified type and description; unknown types keep nulls.

    ``lookup`` has one row per FormType. Spark broadcasts whichever side its size statistics allow.
    """
    return counts.join(lookup, "FormType", "left").select(
        "FormClass", F.col("FormType").alias("FormTypeRaw"), "FormTypeMod", "nDocs", "Description"
    )


def unmapped(types: DataFrame, raw: str, mod: str) -> DataFrame:
    """Raw types without a modified type, sorted."""
    return types.filter(F.col(mod).isNull() & F.col(raw).isNotNull()).select(raw).distinct().orderBy(raw)


def roll_up(types: DataFrame, doc_class: str, mod: str) -> DataFrame:
    """Raw types summed up to modified types, largest first."""
    return (
        types.groupBy(doc_class, mod, "Description")
        .agg(F.sum("nDocs").alias("nDocs"))
        .select(doc_class, mod, "nDocs", "Description")
        .orderBy(F.desc("nDocs"), doc_class, mod, "Description")
    )


def classify_types(counts: DataFrame, rules: Sequence[TypeRule], column: str = "Type") -> DataFrame:
    """Label counted types with the first rule that matches; ``nHit`` counts all that do.

    The rules are a short list, so the regex join is a projection over literals: no join at all, and every
    pattern is compiled once. Types without a hit keep null labels.
    """
    hits = [F.coalesce(F.col(column).rlike(r.regex), F.lit(False)) for r in rules]
    hit_count = sum((h.cast("int") for h in hits), F.lit(0))

    def label(field: str) -> Column:
        return F.coalesce(*[F.when(h, F.lit(getattr(r, field))) for h, r in zip(hits, rules)])

    return counts.select(
        label("doc_class").alias("DocClass"),
        F.col(column).alias("DocTypeRaw"),
        label("doc_type").alias("DocTypeMod"),
        "nDocs",
        label("description").alias("Description"),
        hit_count.alias("nHit"),
    )


# Fixed value: the message for unknown types.
UNKNOWN = "Following Requested DocTypes do not exist: "


class UnknownTypes(ValueError):
    """Requested document types the lookup does not hold."""


def resolve_doc_types(requested: DataFrame, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested modified types to raw types, and one row with the unknown ones joined to a text."""
    wanted = requested.select("DocTypeMod").distinct()
    known = lookup.select("DocTypeMod", "DocTypeRaw").filter(F.col("DocTypeRaw").isNotNull())
    matched = wanted.join(known, "DocTypeMod").select("DocTypeMod", "DocTypeRaw").distinct()
    missing = wanted.join(known, "DocTypeMod", "left_anti").agg(
        F.array_join(F.array_sort(F.collect_set("DocTypeMod")), ", ").alias("Missing"),
        F.count(F.lit(1)).alias("nMissing"),
    )
    return matched, missing


def require_doc_types(requested: DataFrame, lookup: DataFrame) -> DataFrame:
    """As ``resolve_doc_types``, raising for unknown types."""
    matched, missing = resolve_doc_types(requested, lookup)
    row = missing.first()
    if row["nMissing"]:
        raise UnknownTypes(f"{UNKNOWN}{row['Missing']}")
    return matched
