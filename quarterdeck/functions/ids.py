"""Periods, padded ids and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The serialization header the ids are hashed with, as hex. A one-element text vector,
# then the flags of its element for ASCII and for other text.
DIGEST_HEAD = "0000001000000001"
DIGEST_ASCII = "00040009"
DIGEST_UTF8 = "00008009"


def year_quarter(year: Column, quarter: Column) -> Column:
    """2020, 1 -> 2020.1"""
    return F.concat(year.cast("string"), F.lit("."), quarter.cast("string")).cast("double")


def quarter_label(year: Column, quarter: Column) -> Column:
    """2020, 1 -> "2020-1" """
    return F.concat(year.cast("string"), F.lit("-"), quarter.cast("string"))


def label_from_number(period: Column) -> Column:
    """2020.1 -> "2020-1" """
    return F.replace(period.cast("string"), F.lit("."), F.lit("-"))


def pad_cik(cik: Column) -> Column:
    """Left-pad with zeros to 10 characters; longer ids stay whole (a bare lpad would cut them)."""
    return F.when(F.length(cik) >= 10, cik).otherwise(F.lpad(cik, 10, "0"))


def parse_date(text: Column) -> Column:
    """ISO dates with or without dashes; anything else is null."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd")).when(
        text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd")
    )


def digest_id(text: Column) -> Column:
    """MD5 of the serialized text, so ids equal those of tables built earlier."""
    flags = F.when(F.octet_length(text) == F.length(text), F.lit(DIGEST_ASCII)).otherwise(F.lit(DIGEST_UTF8))
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    head = F.unhex(F.concat(F.lit(DIGEST_HEAD), flags, size))
    return F.md5(F.concat(head, text.cast("binary")))


def document_id(cik: Column, hash_document: Column) -> Column:
    return F.concat(cik, F.lit("-"), hash_document)
