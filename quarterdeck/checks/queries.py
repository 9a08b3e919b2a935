"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, html, ids, text, urls
from ..operators import keys, ordered, quality, reshape, types
from ..plans import documents, index, landing, links, lookups, periods
from ..operators.stages import staged
from ..schemas import DOC_LINKS, RUN_LOG, WORK_QUEUE
from ..session import shared_dir
from ..sinks import processed, tables
from ..sources import datasets, files
from ..sources.index_text import add_filing_ids, parse_index
from ..streaming.ingest import ingest
from . import views
from .views import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Reading and selecting filings


@query
def filings_scan(spark, sf):
    return views.filings(spark, sf).filter((F.col("FormType") == "1-URGENT") & (F.col("Quarter") == 4))


@query
def read_filings(spark, sf):
    ciks = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    padded = ciks.select(ids.pad_cik(F.col("c_custkey").cast("string")).alias("CIK"))
    path = shared_dir(spark, "filings")
    tables.write_partitioned(views.with_quarter(views.filings(spark, sf)), path, [tables.QUARTER])
    found = datasets.read_filings(spark, path, from_=1996.2, to=1999.3, ciks=padded, form_types=["1-URGENT", "3-MEDIUM"])
    return found.drop(tables.QUARTER)


@query
def read_links(spark, sf):
    path, index_path = shared_dir(spark, "links"), shared_dir(spark, "filings")
    tables.write_partitioned(views.with_quarter(views.doc_links(spark, sf)), path, [tables.QUARTER])
    tables.write_partitioned(views.with_quarter(views.filings(spark, sf)), index_path, [tables.QUARTER])
    # Types are counted over the links as written, so they are made once.
    wanted = _doc_types(spark, sf, datasets.read_table(spark, path)).filter(F.col("DocTypeMod") == "Type A").select("DocTypeRaw")
    found = datasets.read_links(spark, path, index_path, ["2-HIGH"], from_=1997.1, doc_types=wanted)
    return found.drop(tables.QUARTER)


@query
def filing_ids(spark, sf):
    return views.filings(spark, sf).withColumn("YearQtrSave", ids.quarter_label(F.col("Year"), F.col("Quarter")))


@query
def master_index_parse(spark, sf):
    return parse_index(views.index_lines(spark, sf)).filings


@query
def master_index_quarantine(spark, sf):
    bad = parse_index(views.index_lines(spark, sf)).quarantine
    return bad.groupBy("file", "Reason").agg(F.count(F.lit(1)).alias("nLines"))


@query
def period_bounds(spark, sf):
    found = views.filings(spark, sf)
    return periods.period_bounds(found).select(F.col("from").alias("FirstPeriod"), F.col("to").alias("LastPeriod"))


@query
def period_grid(spark, sf):
    found = views.filings(spark, sf)
    grid = periods.add_sources(periods.grid_between(periods.period_bounds(found)), "MasterIndex")
    counts = found.groupBy("Year", "Quarter").agg(F.count(F.lit(1)).alias("nFilings"))
    return grid.join(counts, ["Year", "Quarter"], "left").withColumn("nFilings", F.coalesce("nFilings", F.lit(0)))


@query
def pending_periods(spark, sf):
    found = views.filings(spark, sf).withColumn("YearQtrSave", ids.label_from_number(F.col("YearQuarter")))
    grid = periods.grid_between(periods.period_bounds(found))
    return periods.pending_periods(grid, found.filter(F.col("DateFiled") < "1999-01-01"))


@query
def selected_filings(spark, sf):
    found = views.filings(spark, sf, ("Status",))
    return keys.only_ids(found.drop("Status"), "HashIndex", views.processed(found).select("HashIndex"))


@query
def pending_filings(spark, sf):
    found = views.filings(spark, sf, ("Status",))
    return links.pending_filings(found, views.processed(found)).drop("Status")


@query
def processed_filter(spark, sf):
    """Pending filings by the filters beside the processed keys, which two runs noted; the second outgrows the first."""
    found, path = staged(views.with_quarter(views.filings(spark, sf, ("Status", "Segment"))), "filings"), shared_dir(spark, "processed")
    done = views.processed(found)
    for run in (done.filter(F.col("Segment") == "BUILDING"), done):
        processed.append_done(spark, run, path, [tables.QUARTER], ["HashIndex"])
    return processed.pending(spark, found, path, [tables.QUARTER], ["HashIndex"]).drop("Status", "Segment", tables.QUARTER)


@query
def distinct_filings(spark, sf):
    return views.filings(spark, sf).select("CIK", "FormType").distinct()


@query
def work_batches(spark, sf):
    found, path = views.filings(spark, sf, ("Status",)), shared_dir(spark, "queue")
    links.write_queue(links.work_queue(links.pending_filings(found, views.processed(found))), path)
    return spark.read.parquet(path).select(*WORK_QUEUE.fieldNames())


@query
def index_job(spark, sf):
    raw, out = shared_dir(spark, "raw"), shared_dir(spark, "index")
    lines = staged(views.index_lines(spark, sf), "lines")
    # One file per quarter, as they are landed.
    for row in lines.select("file").distinct().collect():
        folder = "/".join(row.file.split("/")[-3:-1])
        lines.filter(F.col("file") == row.file).select("value").coalesce(1).write.text(f"{raw}/{folder}")
    # The second run finds all files handled.
    for _ in range(2):
        built = index.build_index(spark, raw, out, date(2002, 1, 1), from_=1995.0)
    return built


@query
def links_job(spark, sf):
    out = shared_dir(spark, "links-job")
    pages = views.link_pages(spark, sf).select("HashIndex", "HTML")
    responses = pages.withColumns({"Error": F.lit(None).cast("string"), "Status": F.lit(200)})
    # The second run finds all pages processed.
    for _ in range(2):
        built = links.build_links(spark, views.filings(spark, sf), responses, out)
    return built.select(*DOC_LINKS.fieldNames())


# Links


@query
def page_links(spark, sf):
    found = links.page_anchors(table(spark, sf, "pages"), ["page_id"], F.col("url"))
    digest = ids.digest_id(F.concat("Href", F.lit("-"), F.col("Seq").cast("string")))
    return found.withColumn(
        "DocID", ids.document_id(ids.pad_cik(F.col("page_id").cast("string")), digest)
    )


@query
def url_absolute(spark, sf):
    found = links.page_anchors(table(spark, sf, "pages"), ["page_id", "url"], F.col("url"))
    relative = F.expr("substring(Href, 2)")
    base = F.col("url")
    return found.select(
        "page_id",
        "Seq",
        F.col("UrlDocument").alias("UrlRoot"),
        urls.url_absolute(relative, base).alias("UrlRelative"),
        urls.url_absolute(F.concat(F.lit(".././"), relative), base).alias("UrlParent"),
        urls.url_absolute(F.concat(F.lit("//other.example.com"), F.col("Href")), base).alias("UrlHost"),
        urls.url_absolute(F.concat(F.lit("ftp://h"), F.col("Href")), base).alias("UrlWhole"),
    )


@query
def url_parts(spark, sf):
    url = F.col("UrlDocument")
    return views.doc_links(spark, sf).select(
        "DocID",
        "UrlDocument",
        urls.file_extension(url).alias("DocExt"),
        urls.content_class(url).alias("ContentClass"),
        urls.is_viewer_url(url).alias("IsViewer"),
        urls.unwrap_viewer(url).alias("UrlPlain"),
        urls.path_of("Original", ids.label_from_number(F.col("YearQuarter")), F.col("Document")).alias("PathOrig"),
    )


@query
def doc_link_table(spark, sf):
    return links.extract_links(views.link_pages(spark, sf))


@query
def clean_columns(spark, sf):
    final = F.col("l_linestatus") == "F"
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_partkey").alias("PartKey"),
        F.when(final, F.col("l_linenumber").cast("string")).otherwise(F.lit("")).alias("Seq"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("bigint").cast("string")).alias("Size"),
        F.concat(F.lit(" \t"), "l_returnflag", F.lit("\r\n ")).alias("Type"),
        F.when(final, F.lit(" \n\t")).otherwise(F.col("l_linestatus")).alias("Description"),
        F.col("l_suppkey").alias("Document"),
    )
    return clean.clean_columns(raw, {"Seq": "int", "Size": "bigint"}, ["Type", "Description", "Document"])


@query
def pages_with_keys(spark, sf):
    found = views.filings(spark, sf, ("OrderKey", "Status"))
    pages = found.select("HashIndex", F.concat(F.lit("<p>"), F.col("OrderKey").cast("string"), F.lit("</p>")).alias("HTML"))
    return links.pages_with_keys(pages, found.filter(F.col("Status") != "P"))


# Landing pages


def _elements(*kinds: str) -> Query:
    def build(spark, sf):
        found = landing.landing_elements(views.landing_pages(spark, sf), kinds)
        return found.select("HashIndex", "Kind", "EntryNum", "Name", "Info")

    return build


QUERIES["landing_grouping"] = _elements("formGrouping", "formName", "secNum")
QUERIES["landing_company"] = _elements("mailer", "companyName")
QUERIES["landing_ident"] = _elements("identInfo")


@query
def landing_pivot(spark, sf):
    found = landing.parse_landing(views.landing_pages(spark, sf))
    pairs = F.transform(F.array_sort(F.map_entries("Other")), lambda p: F.concat(p["key"], F.lit("="), p["value"]))
    return found.withColumn("Other", F.array_join(pairs, ";"))


@query
def attribute_pivot(spark, sf):
    found = reshape.pivot_attributes(views.attributes(spark, sf), ["Entity"], ["view", "click"], F.struct("ts", "EventId"))
    return found.select("Entity", F.col("view").alias("FirstView"), F.col("click").alias("FirstClick"), F.element_at("Other", "error").alias("FirstError"), F.size("Other").alias("nOther"))


@query
def entry_numbers(spark, sf):
    return ordered.number_rows(
        views.attributes(spark, sf), ["Entity", "Name"], [F.col("ts"), F.col("EventId")],
        F.date_trunc("hour", "ts"), "EntryNum",
    ).select("Entity", "EventId", "Name", "EntryNum")


@query
def fill_down(spark, sf):
    wide = views.attributes(spark, sf).select(
        "Entity", "EventId", "ts",
        F.when(F.col("Name") == "view", F.col("Info")).alias("ViewInfo"),
        F.when(F.col("Name") == "error", F.col("Info")).alias("ErrorInfo"),
    )
    filled = ordered.fill_down(
        wide, ["Entity"], [F.col("ts"), F.col("EventId")], F.date_trunc("hour", "ts"), ["ViewInfo", "ErrorInfo"]
    )
    return filled.drop("ts")


# Documents


def _saved_lookups(spark, sf, found):
    """The lookups as jobs use them: built, saved, and read back."""
    path = shared_dir(spark, "lookups")
    lookups.build_type_lookups(views.filings(spark, sf), found, _form_lookup(spark), views.DOC_RULES).save(path)
    return {name: spark.read.parquet(f"{path}/{name}") for name in lookups.SAVED}


def _doc_types(spark, sf, found=None):
    return _saved_lookups(spark, sf, views.doc_links(spark, sf) if found is None else found)["doc_types_raw"].filter("nHit > 0")


def _staged_links(spark, sf, *keep):
    """The columns of the links that documents are chosen by, as jobs find them: a table, made once for all steps that read it."""
    return staged(views.doc_links(spark, sf, keep).select("DocID", "YearQuarter", "Type", "Description", "UrlDocument", *keep), "links")


@query
def docs_by_type(spark, sf):
    found = _staged_links(spark, sf, "LineStatus")
    wanted = found.filter(F.col("LineStatus") == "F").select("DocID").distinct()
    return documents.docs_by_type(found.drop("LineStatus"), _doc_types(spark, sf, found), wanted)


def _pending_documents(spark, sf):
    links_ = _staged_links(spark, sf)
    known = _doc_types(spark, sf, links_)
    found = documents.docs_by_type(links_, known)
    done = found.filter(F.col("DocExt") == "xml").select("TypeSave", "YQSave", "DocID")
    return documents.pending_documents(links_, known, done)


@query
def pending_documents(spark, sf):
    return _pending_documents(spark, sf)


@query
def nest_documents(spark, sf):
    nested = documents.nest_documents(_pending_documents(spark, sf), chunk_rows=100)
    docs = F.transform("Documents", lambda d: F.concat(d["DocID"], F.lit(" "), d["UrlDocument"]))
    return nested.select("TypeSave", "YQSave", "Chunk", F.size("Documents").alias("nDocs"), F.array_join(docs, ",").alias("Docs"))


@query
def group_progress(spark, sf):
    docs = _pending_documents(spark, sf).select("TypeSave", "YQSave", "DocID")
    return documents.group_progress(docs).select("TypeSave", "YQSave", "DocID", "nRow", "nAll", "Print")


@query
def parse_documents(spark, sf):
    return documents.parse_documents(views.raw_files(spark, sf))


@query
def documents_job(spark, sf):
    """Landed files parsed in two runs, of plain texts and of the rest; a third finds nothing to open."""
    raw, out = shared_dir(spark, "landed"), shared_dir(spark, "documents")
    known = spark.createDataFrame([row[1:] for row in views.LANDED_TYPES], "DocTypeRaw string, DocTypeMod string")
    found = staged(views.landed_links(spark, sf), "landed-links")
    placed = documents.docs_by_type(found, known).select("DocID", F.col("PathOrig").alias("path"))
    views.land(placed.join(found, "DocID"), raw)
    for wanted in (found.filter("Type = 'plain'").select("DocID"), None, None):
        built = documents.build_documents(spark, found.drop("content"), known, raw, out, wanted)
    return built


@query
def list_files(spark, sf):
    # Addresses without query and fragment, as the paths of landed files.
    paths = table(spark, sf, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("path"))
    return files.file_ids(paths, r"\.html?$")


@query
def listed_files(spark, sf):
    """Files in folders, one folder per customer's nation, listed without opening any; Listed where none is missing, extra
    or listed twice, held against the files that the table's rows are read from."""
    path = shared_dir(spark, "listed")
    # One split would write all files in one task.
    dealt = table(spark, sf, "customer").repartition(spark.sparkContext.defaultParallelism)
    dealt.write.partitionBy("c_nationkey").option("maxRecordsPerFile", 20).parquet(path)
    found = files.list_files(spark, path, r"^part-.*\.parquet$", recursive=True).filter(F.col("doc_id").startswith("part-"))
    listed = found.groupBy(F.regexp_extract("path", "c_nationkey=[0-9]+/[^/]+$", 0).alias("file")).agg(F.count(F.lit(1)).alias("times"))
    there = spark.read.parquet(path).select(F.regexp_extract(F.input_file_name(), "c_nationkey=[0-9]+/[^/]+$", 0).alias("file")).distinct()
    both = listed.join(there.withColumn("there", F.lit(1)), "file", "full")
    wrong = F.when((F.coalesce("times", F.lit(0)) == 1) & F.col("there").isNotNull(), 0).otherwise(1)
    folder = F.regexp_extract("file", "c_nationkey=([0-9]+)/", 1).cast("int")
    return both.groupBy(folder.alias("Nation")).agg((F.sum(wrong) == 0).alias("Listed"))


@query
def resolve_doc_types(spark, sf):
    requested = table(spark, sf, "lineitem").select(
        F.explode(F.array(
            F.concat(F.lit("Type "), "l_returnflag"), F.concat(F.lit("Type "), "l_linestatus"),
        )).alias("DocTypeMod")
    )
    matched, missing = types.resolve_doc_types(requested, _doc_types(spark, sf))
    return matched.unionByName(missing.select("Missing"), allowMissingColumns=True)


# Text


@query
def standardize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.standardize_text(F.col("text")).alias("TextMod"))


@query
def standardize_text_all(spark, sf):
    every = text.StandardizeOptions(rm_num=True, rm_html=True)
    kept = text.StandardizeOptions(rm_punct=False, to_upper=False, rm_html=True)
    return table(spark, sf, "pages").select(
        "page_id",
        text.standardize_text(F.col("html"), every).alias("TextAll"),
        text.standardize_text(F.col("html"), kept).alias("TextKept"),
    )


@query
def standardize_string(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.standardize_string(F.col("text")).alias("TextMod"))


@query
def html_to_text(spark, sf):
    return html.add_html_text(table(spark, sf, "pages"), "html", "TextRaw").select("page_id", "TextRaw")


@query
def html_to_text_plain(spark, sf):
    # Pages spread over many short lines, so that layout is ignored.
    spread = table(spark, sf, "pages").select("page_id", F.regexp_replace("html", " ", "\n\t ").alias("html"))
    return html.add_html_text(spread, "html", "TextRaw").select("page_id", "TextRaw")


@query
def whitespace_ratio(spark, sf):
    pages = table(spark, sf, "pages").select(F.lit("page").alias("Kind"), F.col("page_id").alias("Id"), F.col("html").alias("c"))
    docs = table(spark, sf, "documents").select(F.lit("document").alias("Kind"), F.col("doc_id").alias("Id"), F.col("text").alias("c"))
    return pages.unionByName(docs).select("Kind", "Id", html.whitespace_ratio(F.col("c")).alias("Ratio"))


# Lookups


def _form_lookup(spark):
    return spark.createDataFrame(
        views.FORM_LOOKUP, "FormType string, FormClass string, FormTypeMod string, Description string"
    )


def _form_types(spark, sf):
    return types.form_types_raw(types.count_types(views.filings(spark, sf), "FormType"), _form_lookup(spark))


@query
def form_type_counts(spark, sf):
    return types.count_types(views.filings(spark, sf), "FormType").orderBy(F.desc("nDocs"), "FormType")


@query
def form_types_raw(spark, sf):
    return _form_types(spark, sf)


@query
def form_types_mod(spark, sf):
    return types.roll_up(_form_types(spark, sf), "FormClass", "FormTypeMod")


@query
def unmapped_types(spark, sf):
    return types.unmapped(_form_types(spark, sf), "FormTypeRaw", "FormTypeMod")


def _classified(spark, sf):
    found = views.doc_links(spark, sf, ("Discount",))
    return _saved_lookups(spark, sf, found.withColumn("Error", (F.col("Discount") > 0.08).cast("int")))


@query
def doc_type_classify(spark, sf):
    return _classified(spark, sf)["doc_types_raw"]


@query
def doc_types_mod(spark, sf):
    return _classified(spark, sf)["doc_types_mod"]


# Merging, quality, logs


@query
def dedupe_first(spark, sf):
    order = [F.col(c) for c in ("l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")]
    first = keys.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query
def union_sources(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("Name"), F.col("s_suppkey").alias("Key"), F.col("s_nationkey").alias("Nation")
    )
    return reshape.union_sources({"customer": customers, "supplier": suppliers}, "Source")


@query
def partitioned_sink(spark, sf):
    path = shared_dir(spark, "index")
    found = views.with_quarter(views.filings(spark, sf))
    tables.write_new_partitions(spark, found.filter(F.col("Year") < 1998), path)
    # Quarters already written stay as they are.
    tables.write_new_partitions(spark, found.withColumn("CompanyName", F.upper("CompanyName")), path)
    return spark.read.parquet(path)


@query
def upsert_keep_existing(spark, sf):
    path = shared_dir(spark, "links")
    found = views.with_quarter(views.doc_links(spark, sf, ("LineStatus",)))
    tables.merge_new(spark, found.filter(F.col("LineStatus") == "F").drop("LineStatus"), path, ["DocID"], links.LINK_ORDER)
    changed = found.drop("LineStatus").withColumn("Description", F.concat(F.lit("New "), "Description"))
    tables.merge_new(spark, changed, path, ["DocID"], links.LINK_ORDER)
    return spark.read.parquet(path).select(*DOC_LINKS.fieldNames())


@query
def incremental_stream(spark, sf):
    target, checkpoint = shared_dir(spark, "stream"), shared_dir(spark, "progress")
    customer = table(spark, sf, "customer")

    def to_filings(orders: DataFrame) -> DataFrame:
        return views.with_quarter(add_filing_ids(views.raw_filings(orders, customer)))

    # Several files in batches of two; the second run finds no new ones.
    source, orders = shared_dir(spark, "landed"), table(spark, sf, "orders")
    orders.repartition(6).write.parquet(source)
    for _ in range(2):
        ingest(spark, source, orders.schema, to_filings, target, checkpoint, ["HashIndex"], ["CIK"], files_per_batch=2)
    return spark.read.parquet(target)


@query
def quarantine_status(spark, sf):
    reason = quality.request_reason(F.col("Error"), F.col("Status"))
    checked = quality.split_valid(views.responses(spark, sf), reason)
    return reshape.union_sources({"valid": checked.valid, "quarantine": checked.quarantine}, "Part").select(
        "Part", "ResponseId", "Status", "Error", "Reason"
    )


@query
def quarantine_content(spark, sf):
    # Whole texts; those of one language stand blank, those of one source missing.
    body = F.when(F.col("lang") == "es", F.lit(" \n")).when(F.col("source") != "src1", F.col("text"))
    found = table(spark, sf, "documents").select("doc_id", body.alias("Content"))
    checked = quality.split_valid(found, quality.content_reason(F.col("Content")))
    return reshape.union_sources({"valid": checked.valid, "quarantine": checked.quarantine}, "Part")


@query
def empty_outputs(spark, sf):
    expected = table(spark, sf, "customer").select(ids.pad_cik(F.col("c_custkey").cast("string")).alias("CIK"))
    return quality.empty_outputs(expected, views.filings(spark, sf).filter(F.col("Year") == 1998), "CIK")


@query
def run_metrics(spark, sf):
    return links.link_metrics(views.doc_links(spark, sf))


@query
def run_log(spark, sf):
    found = views.filings(spark, sf).withColumn("YearQtrSave", ids.label_from_number(F.col("YearQuarter")))
    grid = periods.grid_between(periods.period_bounds(found))
    urgent = found.filter((F.col("FormType") == "1-URGENT") & (F.col("Quarter") != 2))
    counted = quality.empty_outputs(grid, urgent, "YearQtrSave")
    last = found.groupBy("YearQtrSave").agg(F.max("DateFiled").cast("timestamp_ntz").alias("At"))
    path = shared_dir(spark, "log")
    tables.append_run_log(index.quarter_log(counted.join(last, "YearQtrSave"), F.col("At")), path)
    return spark.read.schema(RUN_LOG).option("header", True).option("nullValue", "NA").csv(path)
