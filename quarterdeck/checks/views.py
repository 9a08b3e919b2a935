"""Views of the test tables in the shape of the pipeline's inputs.

The tables hold no index files, link tables or landing pages, so these are rendered from whole tables and the
extractors are checked against the values they were rendered from.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import digest_id, document_id, label_from_number
from ..functions.urls import url_absolute
from ..operators.types import FULL_TEXT_DESCRIPTION, TypeRule
from ..schemas import ARCHIVE_BASE
from ..sinks.tables import QUARTER
from ..sources.datasets import read_table
from ..sources.index_text import add_filing_ids

# Form types with class, modified type and description; one form type is left out on purpose.
FORM_LOOKUP = [
    ("1-URGENT", "Fast", "Priority", "Handled first"),
    ("2-HIGH", "Fast", "Priority", "Handled first"),
    ("3-MEDIUM", "Slow", "Normal", "Handled in turn"),
    ("4-NOT SPECIFIED", "Slow", "Normal", "Handled in turn"),
]

# One type matches two rules, one matches none.
DOC_RULES = [
    TypeRule("Exhibits", "^A-", "Type A", "Accepted lines"),
    TypeRule("Exhibits", "-F$", "Type F", "Finished lines"),
    TypeRule("Main Form/Text", "(?i)^full submission", "Full / Text", "Whole submission"),
]


# Tables that pages, lines and files are rendered from.
RENDERED = {"documents", "pages", "orders", "lineitem"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. One that is a single split is dealt out, as landed files would come in many; jobs never do this."""
    found = read_table(spark, f"{sf}/{name}.parquet")
    if name in RENDERED and found.rdd.getNumPartitions() == 1:
        return found.repartition(spark.sparkContext.defaultParallelism)
    return found


def raw_filings(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders as filings, in the fields of an index line."""
    day = F.to_date("o_orderdate")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    cust, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    return joined.select(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_orderstatus").alias("Status"),
        F.col("c_nationkey").alias("Nation"),
        F.col("c_mktsegment").alias("Segment"),
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        cust.alias("CIK"),
        F.col("c_name").alias("CompanyName"),
        F.col("o_orderpriority").alias("FormType"),
        day.cast("string").alias("DateFiled"),
        F.concat(F.lit("data/"), cust, F.lit("/"), order, F.lit(".txt")).alias("Filename"),
    )


EXTRA = ["OrderKey", "Status", "Nation", "Segment"]


def filings(spark: SparkSession, sf: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return add_filing_ids(raw_filings(table(spark, sf, "orders"), table(spark, sf, "customer")), keep)


def processed(index: DataFrame) -> DataFrame:
    """Filings counted as processed: the finished orders."""
    return index.filter(F.col("Status") == "F")


def index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Filings as lines of quarterly index files, with preamble and header.

    Names of one segment hold a pipe, and the files of 1995 have another header.
    """
    raw = raw_filings(table(spark, sf, "orders"), table(spark, sf, "customer"))
    file = F.format_string("/raw/full-index/%d/QTR%d/master.idx", "Year", "Quarter")
    name = F.when(F.col("Segment") == "MACHINERY", F.concat("CompanyName", F.lit("|Co"))).otherwise(F.col("CompanyName"))
    lines = raw.select(file.alias("file"), F.concat_ws("|", "CIK", name, "FormType", "DateFiled", "Filename").alias("value"))
    preamble = [F.lit(f"Description line {i}:   Master Index") for i in range(1, 9)] + [F.lit("")]
    header = F.when(F.col("Year") == 1995, F.lit("CIK|Name|Form Type|Date Filed|Filename")).otherwise(
        F.lit("CIK|Company Name|Form Type|Date Filed|Filename")
    )
    files = raw.select("Year", "Quarter").distinct()
    heads = files.select(file.alias("file"), F.explode(F.array(*preamble, header, F.lit("-" * 80))).alias("value"))
    return lines.unionByName(heads)


def line_items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as raw links of filings: Href and the columns of a link table, with OrderKey's filing keys."""
    index = filings(spark, sf, ("OrderKey", "Status")).select("HashIndex", "CIK", "YearQuarter", "OrderKey", "Status")
    items = table(spark, sf, "lineitem").join(index, F.col("l_orderkey") == F.col("OrderKey"))
    line = F.col("l_linenumber")
    ext = (
        F.when(line == 1, F.lit(".htm")).when(line == 2, F.lit(".HTML")).when(line == 3, F.lit(".txt"))
        .when(line == 4, F.lit(".xml")).when(line == 5, F.lit(".pdf")).when(line == 6, F.lit(".xsd"))
        .otherwise(F.lit(""))
    )
    part = F.col("l_partkey").cast("string")
    whole = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    folder = F.concat(F.lit("/Archives/data/"), F.col("l_orderkey").cast("string"), F.lit("/"))
    viewer = F.when(line == 1, F.lit("/ix?doc=")).otherwise(F.lit(""))
    return items.select(
        "HashIndex",
        "CIK",
        "YearQuarter",
        "Status",
        F.col("l_linestatus").alias("LineStatus"),
        F.col("l_discount").alias("Discount"),
        F.col("l_orderkey").alias("OrderKey"),
        line.alias("Seq"),
        F.when(whole, F.lit(FULL_TEXT_DESCRIPTION)).otherwise(F.concat(F.lit("Part "), part)).alias("Description"),
        F.concat(part, ext).alias("Document"),
        F.when(~whole, F.concat_ws("-", "l_returnflag", "l_linestatus")).alias("Type"),
        F.col("l_quantity").cast("bigint").alias("Size"),
        F.concat(viewer, folder, part, ext).alias("Href"),
    )


def doc_links(spark: SparkSession, sf: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Line items as document links."""
    items = line_items(spark, sf)
    digest = digest_id(F.concat("Href", F.lit("-"), F.col("Seq").cast("string")))
    return items.withColumn("HashDocument", digest).select(
        "HashIndex",
        "CIK",
        document_id(F.col("CIK"), F.col("HashDocument")).alias("DocID"),
        "HashDocument",
        "YearQuarter",
        "Seq",
        "Description",
        "Document",
        "Type",
        "Size",
        url_absolute(F.col("Href"), ARCHIVE_BASE).alias("UrlDocument"),
        *keep,
    )


def with_quarter(df: DataFrame) -> DataFrame:
    return df.withColumn(QUARTER, label_from_number(F.col("YearQuarter")))


def _html(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("&nbsp;")) for p in parts])


def link_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page for every line item: a link table with its document and with the whole submission."""
    items = line_items(spark, sf)
    open_block = F.when(F.col("LineStatus") == "O", F.lit('<div class="x formDiv">')).otherwise(F.lit('<div id="formDiv">'))
    return items.select(
        "HashIndex",
        "CIK",
        "YearQuarter",
        _html(
            "<!DOCTYPE html><html><head><title>Filing</title><script>var a='<table>';</script></head><body>",
            '<table><tr><th>Seq</th></tr><tr><td><a href="/menu">9</a></td></tr></table>',
            open_block,
            '<p>Document Format Files</p><table class="tableFile" summary="Files">\n<tr>',
            '<th scope="col">Seq</th><th scope="col">Description</th><th scope="col">Document</th>',
            '<th scope="col">Type</th><th scope="col">Size</th></tr>\n<tr class="evenRow"><td>',
            F.col("Seq"), "</td><td>", F.col("Description"), '</td>\n<td><a class="d" href="', F.col("Href"), '">',
            F.col("Document"), "</a></td><td>", F.col("Type"), "</td><td> ", F.col("Size"), " </td></tr>\n",
            "<tr><td>&nbsp;</td><td>Complete submission text file</td>",
            '<td><a href="/Archives/data/', F.col("OrderKey"), '.txt">', F.col("OrderKey"), ".txt</a></td>",
            "<td>&nbsp;</td><td></td></tr></table></div></body></html>",
        ).alias("HTML"),
    )


def landing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A landing page for every filing; urgent open filings have none, open filings name a second company."""
    index = filings(spark, sf, tuple(EXTRA))
    order, nation = F.col("OrderKey"), F.col("Nation")
    second = F.when(
        F.col("Status") == "O",
        _html(
            '<span class="companyName">Partner ', order, " (Subject) <acronym>CIK</acronym>: <a>", F.col("CIK"),
            "</a></span><p class=\"identInfo\">State of Incorp.: <strong>X", nation, "</strong></p>",
        ),
    ).otherwise(F.lit(""))
    html = _html(
        "<html><head><title>Landing</title></head><body><div id='formName'><strong>Form ", F.col("FormType"),
        "</strong> - Report:</div>\n<div id=secNum><strong>SEC Accession <acronym title='Number'>No.</acronym></strong> ",
        order, "</div>\n<div class='formGrouping'><div class='infoHead'>Filing Date</div><div class=\"info\">",
        F.col("DateFiled"), "</div><div class='infoHead'>Accepted</div><div class='info'>", F.col("DateFiled"),
        " 00:00:00</div></div><div class='formGrouping'><div class='infoHead'>Lead &amp; Part.</div><div class='info'>",
        F.col("Segment"), "</div></div>\n<div class='mailer'>Mailing Address <span>", nation, " Main St</span><br>",
        "<span>City ", nation, "</span></div><div class='mailer'>Business Address <span>", nation,
        " High St</span></div>\n<div><span class='companyName'>", F.col("CompanyName"),
        " (Filer)\n <acronym title='Key'>CIK</acronym>: <a href='/c'>", F.col("CIK"),
        " (see all company filings)</a></span><p class='identInfo'><acronym>IRS No.</acronym>: <strong>", order,
        "</strong> | State of Incorp.: <strong>N", nation, "</strong> | Fiscal Year End: <strong>1231</strong><br>",
        "Type: <strong>", F.col("FormType"), "</strong> | Act: <strong>34</strong> | File No.: <a><strong>001:",
        order, "</strong></a><br/><acronym>SIC</acronym>: <b><a>", nation, "</a></b> Some Industry</p></div>",
        second, "</body></html>",
    )
    missing = (F.col("Status") == "O") & (F.col("FormType") == "1-URGENT")
    return index.select("HashIndex", F.when(~missing, html).alias("HTML"))


def raw_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as text files, pages as HTML files, landed pages of an unsupported kind."""
    documents = table(spark, sf, "documents").select(
        F.format_string("Original/d%d.txt", "doc_id").alias("path"), F.col("text").cast("binary").alias("content")
    )
    pages = table(spark, sf, "pages")
    html = pages.select(
        F.format_string("Original/p%d.HTM", "page_id").alias("path"), F.col("html").cast("binary").alias("content")
    )
    other = pages.select(
        F.format_string("Original/z%d.zip", "page_id").alias("path"), F.col("url").cast("binary").alias("content")
    )
    return documents.unionByName(html).unionByName(other)


#: Extension of a landed file, its raw type and modified type.
LANDED_TYPES = [("txt", "plain", "Text"), ("htm", "web", "Web / Page"), ("zip", "packed", "Other")]


def landed_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of the documents in ``raw_files``, spread over twelve quarters, with the file's content."""
    files = raw_files(spark, sf).withColumn("DocID", F.regexp_extract("path", "([^/]+)[.]", 1))
    number, ext = F.regexp_extract("DocID", "([0-9]+)$", 1).cast("long"), F.lower(F.regexp_extract("path", "[.]([^.]+)$", 1))
    kind = F.lit(None).cast("string")
    for name, raw, _ in LANDED_TYPES:
        kind = F.when(ext == name, F.lit(raw)).otherwise(kind)
    return files.select(
        "DocID",
        kind.alias("Type"),
        F.round(2000 + number % 3 + (number % 4 + 1) / 10, 1).alias("YearQuarter"),
        F.concat(F.lit("https://files.example.com/"), "DocID", F.lit("."), ext).alias("UrlDocument"),
        "content",
    )


def land(files: DataFrame, root: str) -> None:
    """Write files (path below ``root``, content) one by one, as a fetch leaves them; local folders only."""

    def write(rows) -> None:
        for row in rows:
            place = os.path.join(root.removeprefix("file:"), row.path)
            os.makedirs(os.path.dirname(place), exist_ok=True)
            with open(place, "wb") as file:
                file.write(row.content)

    files.select("path", "content").foreachPartition(write)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Events as responses: transport errors, statuses, content."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("ResponseId"),
        F.when(kind == "error", F.lit("Timeout was reached")).alias("Error"),
        F.when(kind == "view", F.lit(200)).when(kind == "click", F.lit(204)).when(kind == "purchase", F.lit(404))
        .when(kind == "signup", F.lit(302)).cast("int").alias("Status"),
        F.col("props").alias("Content"),
    )


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as long attributes: entity, name, value."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("Entity"),
        F.col("event_id").alias("EventId"),
        "ts",
        F.col("event_type").alias("Name"),
        F.col("value").alias("Info"),
    )
