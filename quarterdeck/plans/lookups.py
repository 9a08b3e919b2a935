"""Lookup tables of form and document types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.types import TypeRule, classify_types, count_types, form_types_raw, full_text_type, roll_up, unmapped


SAVED = ("form_types_raw", "form_types_mod", "doc_types_raw", "doc_types_mod")


@dataclass(frozen=True)
class TypeLookups:
    form_types_raw: DataFrame
    form_types_mod: DataFrame
    form_types_unmapped: DataFrame
    doc_types_raw: DataFrame
    doc_types_mod: DataFrame

    def save(self, out_dir: str) -> None:
        for name in SAVED:
            getattr(self, name).write.mode("overwrite").parquet(f"{out_dir}/{name}")


def doc_type_counts(links: DataFrame) -> DataFrame:
    """Document types of the links that were read without error."""
    typed = links.filter(F.col("Error") == 0) if "Error" in links.columns else links
    return count_types(typed.select(full_text_type(F.col("Type"), F.col("Description")).alias("Type")), "Type")


def build_type_lookups(
    index: DataFrame, links: DataFrame, form_lookup: DataFrame, rules: Sequence[TypeRule]
) -> TypeLookups:
    """Count the types in use, label them, and roll them up. Types are counted before any is labelled."""
    forms = form_types_raw(count_types(index, "FormType"), form_lookup)
    docs = classify_types(doc_type_counts(links), rules)
    return TypeLookups(
        forms,
        roll_up(forms, "FormClass", "FormTypeMod"),
        unmapped(forms, "FormTypeRaw", "FormTypeMod"),
        docs,
        roll_up(docs, "DocClass", "DocTypeMod"),
    )
