import random
from datetime import date

from pyspark.sql import functions as F

from quarterdeck.checks import queries
from quarterdeck.operators import keys
from quarterdeck.plans import documents, index, landing, links, periods
from quarterdeck.schemas import DOC_LINKS, MASTER_INDEX
from quarterdeck.sinks import tables
from quarterdeck.sources import datasets, files, landed
from quarterdeck.streaming.ingest import ingest

PREAMBLE = "".join(f"Line {i}\n" for i in range(8)) + "\n"
HEADER = "CIK|Company Name|Form Type|Date Filed|Filename\n" + "-" * 80 + "\n"


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content) if isinstance(content, bytes) else path.write_text(content)


def test_periods(spark):
    assert periods.default_bounds(date(2024, 2, 1)) == (1993.1, 2024.0)
    labels = [r.YearQtrSave for r in periods.period_grid(spark, date(2024, 2, 1), from_=2023.3).collect()]
    assert labels == ["2023-3", "2023-4"]
    assert periods.period_grid(spark, date(2024, 2, 1), from_=1900.1, to=1993.2).count() == 2
    assert periods.period_grid(spark, date(2024, 2, 1), from_=2030.1).count() == 0

    def grid(low, high):
        return [r.YearQtrSave for r in periods.period_grid(spark, date(2024, 2, 1), from_=low, to=high).orderBy("YearQuarter").collect()]

    assert grid(2001.0, 2001.5) == grid(2001, 2001.45) == ["2001-1", "2001-2", "2001-3", "2001-4"]
    assert grid(2001.1, 2002) == ["2001-1", "2001-2", "2001-3", "2001-4"] and grid(2001.15, 2001.3) == ["2001-2", "2001-3"]
    assert periods.period_grid(spark, date(2024, 2, 1)).count() == 4 * 31


def test_build_index(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    good = "320193|Apple|10-K|2020-01-31|data/320193/1.txt\n12345678901|Long|8-K|soon|data/1/2.txt\n"
    write(raw / "2020" / "QTR1" / "master.idx", PREAMBLE + HEADER + good + "1|Pipe|Co|8-K|2020-01-01|x.txt\n")
    write(raw / "2020" / "QTR2" / "master.idx", PREAMBLE + "Cik|Name|A|B|C\n----\n1|A|8-K|2020-04-01|x.txt\n")
    write(raw / "2020" / "QTR3" / "master.idx", "")
    built = index.build_index(spark, str(raw), out, date(2021, 1, 1), from_=2020.1)
    rows = {r.CIK: r for r in built.collect()}
    assert set(rows) == {"0000320193", "12345678901"}
    apple = rows["0000320193"]
    assert apple.UrlIndexPage == "https://www.sec.gov/Archives/data/320193/1-index.html"
    assert (apple.DateFiled, apple.YearQuarter, apple.YearQtr) == (date(2020, 1, 31), 2020.1, "2020-1")
    assert rows["12345678901"].DateFiled is None
    assert set(MASTER_INDEX.fieldNames()) <= set(built.columns)
    reasons = [r.Reason for r in spark.read.parquet(out + "/Quarantine").collect()]
    assert sorted(reasons) == ["Unexpected Header"] * 2 + ["Unexpected Number of Fields"]
    log = spark.read.option("header", True).csv(out + "/Log").collect()
    assert sorted(r.Level for r in log) == ["ERROR", "ERROR", "ERROR", "INFO", "INFO"]
    # Handled files are not read again, so nothing is set aside twice.
    index.build_index(spark, str(raw), out, date(2021, 1, 1), from_=2020.1)
    assert spark.read.parquet(out + "/Quarantine").count() == 3
    assert spark.read.option("header", True).csv(out + "/Log").filter("Message = 'No New Year-Quarters'").count() == 1
    # A second run adds only what is new.
    write(raw / "2020" / "QTR4" / "master.idx", PREAMBLE + HEADER + "7|New|10-K|20201231|data/7/9.txt\n")
    assert index.build_index(spark, str(raw), out, date(2021, 1, 1), from_=2020.1).count() == 3


def test_build_index_of_bad_files_only(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write(raw / "2020" / "QTR2" / "master.idx", PREAMBLE + "Cik|Name|A|B|C\n----\n1|A|8-K|2020-04-01|x.txt\n")
    for _ in range(2):
        built = index.build_index(spark, str(raw), out, date(2021, 1, 1), from_=2020.1)
        assert built.count() == 0 and set(MASTER_INDEX.fieldNames()) <= set(built.columns)
    assert spark.read.parquet(out + "/Quarantine").count() == 2


def test_half_written_partition_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("q", 1), ("q", 2), ("r", 3)], "YearQtr string, v int")
    tables.write_partitioned(rows.filter("v = 1"), path, ["YearQtr"])  # a run that failed after one file
    for _ in range(2):
        tables.write_new_partitions(spark, rows, path)
        assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    tables.write_new_partitions(spark, rows.withColumn("v", F.lit(9)), path)
    assert spark.read.parquet(path).filter("v = 9").count() == 0


LINK_PAGE = """<div class="formDiv"><table><tr><th>Seq</th><th>Document</th><th>Type</th><th>Size</th></tr>
<tr><td>1</td><td><a href='/ix?doc=/Archives/a&amp;b.htm'>a &amp; b</a> x</td><td>10-K</td><td>12</td></tr>
<tr><td></td><td>none</td><td>&nbsp;</td><td></td></tr></table>
<table><tr><td>no head</td></tr></table></div><table><tr><th>Seq</th></tr><tr><td>9</td></tr></table>"""


def test_links(spark):
    pages = spark.createDataFrame(
        [("h1", "c", 2020.1, LINK_PAGE), ("h2", "c", 2020.1, "<p>formDiv</p>"), ("h3", "c", 2020.1, None), ("h4", "c", 2020.1, "<p>")],
        "HashIndex string, CIK string, YearQuarter double, HTML string",
    )
    rows = sorted(links.extract_links(pages).collect(), key=lambda r: -r.Seq)
    assert [(r.Seq, r.Document, r.Type, r.Size, r.UrlDocument) for r in rows] == [
        (1, "a & b x", "10-K", 12, "https://www.sec.gov/ix?doc=/Archives/a&b.htm"),
        (-1, "none", None, -1, None),
    ]
    by_id = LINK_PAGE + "<div id=formDiv><table><tr><th>Seq<th>Size<tr><td>3<td>4</table></div>"
    chosen = links.extract_links(spark.createDataFrame([("h", "c", 2020.1, by_id)], pages.schema)).collect()
    assert [(r.Seq, r.Size) for r in chosen] == [(3, 4)]
    assert {r.HashIndex for r in links.pages_without_links(pages).collect()} == {"h2", "h3", "h4"}
    spans = "<div id=formDiv><table><tr><th colspan=2>Seq<th>Document<th>Type<th>Size<tr><td COLSPAN='2'>3<td>d<td>t<td>4</table></div>"
    wide = links.extract_links(spark.createDataFrame([("h", "c", 2020.1, spans)], pages.schema)).first()
    assert (wide.Seq, wide.Document, wide.Type, wide.Size) == (3, "d", "t", 4)
    tall = (
        "<div id=formDiv><table><tr><th>Seq<th>Document<th>Type<th>Size<tr><td>1<td rowspan=2 colspan='1'>d<td>t<td>4"
        "<tr><td>2<td>u<td>5<tr><td>3<td>e<td rowspan='0'>v<td>6<tr><td>4<td>f<td>7</table></div>"
    )
    rows = links.extract_links(spark.createDataFrame([("h", "c", 2020.1, tall)], pages.schema)).orderBy("Seq").collect()
    assert [(r.Seq, r.Document, r.Type, r.Size) for r in rows] == [(1, "d", "t", 4), (2, "d", "u", 5), (3, "e", "v", 6), (4, "f", "v", 7)]


def test_anchors_in_every_form(spark):
    page = """<a href='/x'>1</a><a class=k href=/y>2</a><A HREF="/z?a=1&amp;b=2">3</A><!-- <a href="/no">n</a> --><script>'<a href="/s">'</script>"""
    found = links.page_anchors(spark.createDataFrame([(1, page)], "id int, html string"), ["id"], F.lit("https://h/"))
    assert [(r.Seq, r.Href) for r in found.orderBy("Seq").collect()] == [(1, "/x"), (2, "/y"), (3, "/z?a=1&b=2")]


def test_build_links_and_queue(spark, tmp_path, monkeypatch):
    filings = spark.createDataFrame(
        [(f"h{i}", "c", "10-K", 2020.1, f"u{i}", "n") for i in range(25)],
        "HashIndex string, CIK string, FormType string, YearQuarter double, UrlIndexPage string, CompanyName string",
    )
    responses = spark.createDataFrame(
        [("h1", LINK_PAGE, None, 200), ("h1", LINK_PAGE, None, 200), ("h2", "<p>", None, 200), ("h3", "x", None, 500)],
        "HashIndex string, HTML string, Error string, Status int",
    )
    out = str(tmp_path / "links")
    cut, sizes, whole = [], [], links.cut_pages

    def counted(pages, keys):
        cut.append(pages.filter("Refused is null").count())
        return whole(pages, keys)

    monkeypatch.setattr(links, "cut_pages", counted)
    for _ in range(2):
        assert links.build_links(spark, filings, responses, out).count() == 2
        sizes.append(spark.read.option("header", True).csv(out + "/Log").count())
    # The second run reads no page that was processed, and reports nothing again.
    assert cut == [3, 0] and sizes[0] == sizes[1] == 4
    assert [tuple(r) for r in spark.read.parquet(out + "/Rejected").collect()] == [("h3", "Status Code (500)")]
    done = spark.read.parquet(out + "/Processed")
    assert {r.HashIndex for r in done.collect()} == {"h1", "h2"}
    assert sorted(r.HashIndex for r in spark.read.parquet(out + "/Pages").collect()) == ["h1", "h2"]
    details = {r.Message: r.Details for r in spark.read.option("header", True).csv(out + "/Log").collect()}
    assert details["Extracted Links of Year-Quarter: 2020-1"] == "Rows: 2" and details["Start Extracting Links, Pages: 2"] == "NA"
    queue = links.work_queue(links.pending_filings(filings, done))
    assert sorted(queue.groupBy("Seq").count().collect()) == [(1, 10), (2, 10), (3, 3)]
    links.write_queue(queue, str(tmp_path / "queue"))
    assert spark.read.parquet(str(tmp_path / "queue")).filter("FormTypeSave = '10K'").count() == 23


def test_periods_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "filings")
    rows = [(f"h{y}{q}", "c", "10-K", y + q / 10, f"{y}-{q}") for y in (1999, 2000, 2001) for q in (1, 2, 3, 4)]
    table = spark.createDataFrame(rows, "HashIndex string, CIK string, FormType string, YearQuarter double, YearQtr string")
    tables.write_partitioned(table, path, ["YearQtr"])
    cases = [(1999.3, 2001.1), (1999.0, 1999.45), (1999.15, 2000.3), (2000.4, None), (None, 1999.1), (2000, 2001), (2005.1, None)]
    for low, high in cases:
        found = datasets.read_filings(spark, path, from_=low, to=high)
        wanted = {r[4] for r in rows if (low is None or r[3] >= low) and (high is None or r[3] <= high)}
        assert {r.YearQtr for r in found.collect()} == wanted
        # Whole partitions are left out before any file is opened.
        assert len(found.inputFiles()) >= len(wanted)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(YearQtr" in plan
        scanned = spark.read.parquet(path).filter(datasets.in_partitions(low, high)).select("YearQtr").distinct().count()
        assert scanned == len(wanted)
    # A table without the partition column is filtered by the number alone.
    assert datasets.select_filings(table.drop("YearQtr"), from_=2000.1, to=2000.2).count() == 2


def test_bodies_move_once(spark, tmp_path):
    """Balanced as landed; above the staged table no exchange holds a body."""
    rows = [("a", "c", 2020.1, "2020-1", "x", None, 200), ("a", "c", 2020.1, "2020-1", "x", None, 200), ("b", "c", 2020.1, "2020-1", "y", None, 200)]
    landed = spark.createDataFrame(rows, "HashIndex string, CIK string, YearQuarter double, YearQtr string, HTML string, Error string, Status int")
    cut, path = links.cut_table(landed), str(tmp_path / "Pages")
    for expected in (["a", "b"], []):
        pages = links.new_pages(spark, cut, path)
        assert sorted(r.HashIndex for r in pages.collect()) == expected
        plan = pages._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        tables.write_partitioned(pages, path, ["YearQtr"], balanced=False)
    assert spark.read.parquet(path).count() == 2


def test_pages_without_links_are_noted(spark, tmp_path):
    filings = spark.createDataFrame([("h", "c", 2020.1)], "HashIndex string, CIK string, YearQuarter double")
    responses = spark.createDataFrame([("h", "<div id=formDiv><table><tr><th>Seq</table></div>", None, 200)], "HashIndex string, HTML string, Error string, Status int")
    for _ in range(2):
        assert links.build_links(spark, filings, responses, str(tmp_path)).count() == 0
    assert spark.read.parquet(f"{tmp_path}/Processed").count() == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/Log").count() == 2  # its start, and the page without links


def test_landing(spark):
    page = (
        "<div class='formGrouping'><div class='infoHead'>Filing Date</div><div class='info'>2020-01-01</div>"
        "<div class='infoHead'>Lost</div></div><span class=companyName>A (Filer)\n CIK: <b>1 (see all company filings)</b></span>"
        "<p class=identInfo>Type: <b>8-K</b> | Odd: <i>x:y</i><br>SIC: <b>12</b> Some SIC text</p>"
        "<span class=companyName>B CIK: 2</span><p class=identInfo>Type: 10-K</p>"
    )
    pages = spark.createDataFrame([("p", page), ("p", page), ("n", None), ("e", "<p>x</p>")], "HashIndex string, HTML string")
    rows = {(r.HashIndex, r.EntryNum): r for r in landing.parse_landing(pages).collect()}
    assert set(rows) == {("p", 1), ("p", 2), ("n", None)}
    one, two = rows["p", 1], rows["p", 2]
    assert (one.FilingDate, one.CompanyName, one.Cik, one.Type, one.Sic, one.Other) == (
        "2020-01-01", "A", "1", "8-K", "12", {"Odd": "x:y"},
    )
    assert (two.FilingDate, two.CompanyName, two.Cik, two.Type, two.Sic, two.Other) == (
        "2020-01-01", "B CIK", "2", "10-K", "12", {"Odd": "x:y"},
    )
    assert (rows["n", None].Error, rows["n", None].Message) == (1, "Error: No HTML Supplied")


def test_landing_pages_are_shuffled_once(spark):
    pages = spark.createDataFrame([("p", "<p>")], "HashIndex string, HTML string")
    plan = landing.parse_landing(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_landing_entries_are_not_sorted_as_rows(spark):
    """Pages are sorted to drop copies, as one string each; their entries are numbered and filled within the page."""
    pages = spark.createDataFrame([("p", "<p>")], "HashIndex string, HTML string")
    for found in (landing.parse_landing(pages), landing.landing_elements(pages)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert (plan.count("Window ["), plan.count("Sort ["), plan.count("Aggregate(")) == (1, 2, 0)


def test_landing_entries_are_numbered_by_name(spark):
    """Headings without text and text without heading, boxes in boxes, repeated names, empty fields, characters used as marks."""
    heads = ["A", "B", "A", "", "A\x1e\x1f\x1dB"]
    box = "<div class='formGrouping'>{}</div>".format
    pair = "<b class='infoHead'>{}</b><b class='info'>{}</b>".format
    page = (
        box("".join(pair(h, f"v{k}") for k, h in enumerate(heads)) + box("<b class=info>alone</b>" + pair("A", "")) + "<b class=infoHead>Lost</b>")
        + "<p class=identInfo>X: 1 | X: 2</p><p class=identInfo>X: 3</p>" + "<div class=mailer>Mailing Address M</div>" * 2
    )
    found = landing.landing_elements(spark.createDataFrame([("p", page), (None, page), (None, page)], "HashIndex string, HTML string")).collect()
    rows = sorted((r.Kind, r.Name, r.EntryNum, r.Info) for r in found if r.HashIndex)
    assert rows == sorted((r.Kind, r.Name, r.EntryNum, r.Info) for r in found if r.HashIndex is None)
    assert rows == [
        ("formGrouping", "A", 1, "v0"), ("formGrouping", "A", 2, "v2"), ("formGrouping", "A", 3, "alone"), ("formGrouping", "AB", 1, "v4"),
        ("formGrouping", "B", 1, "v1"), ("identInfo", "X", 1, "1"), ("identInfo", "X", 1, "2"), ("identInfo", "X", 2, "3"),
        ("mailer", "Mailing Address", 1, "M"), ("mailer", "Mailing Address", 2, "M"),
    ]


def test_entries_take_over_what_came_before(spark):
    """Against a plain loop: nulls leave known values, stand as unknown ones; of repeats the first counts."""
    rng = random.Random(7)
    rows = [("p%d" % rng.randrange(6), rng.choice([1, 2, 3, 5, 12]), rng.choice("ABXYZ"), rng.choice([None, "1", "2", "3"]), n) for n in range(400)]
    table = spark.createDataFrame(rows, "HashIndex string, EntryNum int, Name string, Info string, at int")
    wanted = {}
    for page in {r[0] for r in rows}:
        state = {}
        for entry in sorted({r[1] for r in rows if r[0] == page}):
            seen = set()
            for _, _, name, info, _ in sorted((r for r in rows if r[:2] == (page, entry)), key=lambda r: r[4]):
                if name not in seen and (info is not None or name not in "AB"):
                    state[name] = info
                seen.add(name)
            wanted[page, entry] = dict(state)
    found = landing.filled_entries(table, ["A", "B"]).collect()
    assert {(r.HashIndex, r.EntryNum): r.held for r in found} == wanted and len(found) == len(wanted)


def test_landing_elements_leave_each_other_alone(spark):
    """Control characters, and elements that leave a title or preformatted text open."""
    rest = "<div class=mailer>Mailing Address X</div><p class=identInfo>Type: <b>8-K</b></p>"
    heads = ["a\x1eb", "<title>open", "<pre>  open", "\x01\x02\x05\x06"]
    pages = spark.createDataFrame([(str(k), f"<div id=formName>{h}</div>{rest}") for k, h in enumerate(heads)] + [("b", "  "), ("c", "")], "HashIndex string, HTML string")
    rows = {r.HashIndex: r for r in landing.parse_landing(pages).collect()}
    assert all((rows[str(k)].MailingAddress, rows[str(k)].Type) == ("X", "8-K") for k in range(4))
    assert rows["0"].CurrentReport == "ab"
    assert rows["b"].Error == rows["c"].Error == 1


def test_unknown_attributes_fill_down_by_name(spark):
    company = "<span class=companyName>C CIK: 1</span><p class=identInfo>{}</p>"
    page = "".join(company.format(x) for x in ["A: 1 | B: 2", "C: 3", "A: 4"])
    rows = {r.EntryNum: r.Other for r in landing.parse_landing(spark.createDataFrame([("p", page)], "HashIndex string, HTML string")).collect()}
    assert rows == {1: {"A": "1", "B": "2"}, 2: {"A": "1", "B": "2", "C": "3"}, 3: {"A": "4", "B": "2", "C": "3"}}


def test_documents(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "docs")
    write(raw / "Original" / "AB" / "2020-1" / "c-1.HTM", "<p>Grüße &amp; <b>mehr</b></p>")
    write(raw / "Original" / "AB" / "2020-1" / "c-2.txt", b"bad \xff byte")
    write(raw / "Original" / "AB" / "2020-1" / "c-3.pdf", b"%PDF")
    write(raw / "Original" / "AB" / "2020-1" / "c-4.htm", "<script>x</script>")
    write(raw / "Original" / "AB" / "2020-1" / "c-5.txt", "not wanted")
    found = files.list_files(spark, str(raw), r"\.(txt|pdf)$", recursive=True)
    assert sorted(r.doc_id for r in found.collect()) == ["c-2", "c-3", "c-5"]
    assert files.list_files(spark, str(raw / "Original" / "AB" / "2020-1")).count() == 5
    rows = [("i", "c", f"c-{i}", str(i), 2020.1, i, None, None, t, 1, f"https://h/c.{e}")
            for i, t, e in [(1, "T", "HTM"), (2, "T", "txt"), (3, "T", "pdf"), (4, "T", "htm"), (5, "?", "txt"), (6, "T", "")]]
    table = spark.createDataFrame(rows, DOC_LINKS)
    types = spark.createDataFrame([("T", "A / B")], "DocTypeRaw string, DocTypeMod string")
    for _ in range(2):
        built = {r.DocID: r for r in documents.build_documents(spark, table, types, str(raw), out).collect()}
    assert set(built) == {"c-1", "c-2", "c-3", "c-4"}
    assert (built["c-1"].TextRaw, built["c-1"].TextMod, built["c-1"].DocExt) == ("Grüße & mehr", "GRUSSE MEHR", "htm")
    assert built["c-2"].TextRaw == "bad � byte" and not built["c-2"].ErrParse
    assert (built["c-3"].MsgParse, built["c-3"].ErrParse) == ("pdf is not supported", True)
    assert (built["c-4"].MsgParse, built["c-4"].ErrParse) == ("no text found", True)
    assert (built["c-1"].TypeSave, built["c-1"].YQSave) == ("AB", "2020-1")
    assert documents.pending_documents(table, types, spark.read.parquet(out + "/Parsed")).count() == 0
    # With nothing pending nothing is listed, and one new file opens one file.
    log = lambda: sorted(r.Message for r in spark.read.option("header", True).csv(out + "/Log").collect())
    listed = []
    monkeypatch.setattr(documents, "landed_files", lambda s, roots, **o: listed.append(roots) or landed.landed_files(s, roots, **o))
    documents.build_documents(spark, table, types, str(raw), out)
    assert listed == [] and log() == [documents.PARSED + "4"]
    write(raw / "Original" / "AB" / "2020-2" / "c-7.txt", "new")
    more = spark.createDataFrame([("i", "c", "c-7", "7", 2020.2, 7, None, None, "T", 1, "https://h/c.txt")], DOC_LINKS)
    assert documents.build_documents(spark, table.unionByName(more), types, str(raw), out).count() == 5
    assert listed == [[f"{raw}/Original/AB/2020-2"]] and log() == [documents.PARSED + "1", documents.PARSED + "4"]


def test_saved_types_join_without_a_shuffle(spark, tmp_path):
    spark.createDataFrame([("T", "A / B", 1)], "DocTypeRaw string, DocTypeMod string, nHit int").write.parquet(str(tmp_path / "types"))
    rows = spark.createDataFrame([(2020.1, "T", "d", "https://h/c.txt")], "YearQuarter double, Type string, DocID string, UrlDocument string")
    plan = documents.docs_by_type(rows, spark.read.parquet(str(tmp_path / "types")))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_merge_keeps_existing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("q", "a", 2), ("q", "a", 1), ("r", "b", 1)], "YearQtr string, k string, v int")
    tables.merge_new(spark, first, path, ["k"], ["v"])
    tables.merge_new(spark, first.withColumn("v", F.lit(9)).union(spark.createDataFrame([("q", "c", 3)], first.schema)), path, ["k"], ["v"])
    rows = {(r.YearQtr, r.k): r.v for r in spark.read.parquet(path).collect()}
    assert rows == {("q", "a"): 1, ("r", "b"): 1, ("q", "c"): 3}
    # Only the quarters that the new rows touch are read.
    pruned = tables.touched(spark.read.parquet(path), first.filter("YearQtr = 'r'"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [YearQtr" in pruned and "IN (r)" in pruned or "= r" in pruned


def test_stream_in_bounded_batches(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = spark.createDataFrame([("q", str(i % 40)) for i in range(60)], "YearQtr string, k string")
    rows.repartition(6).write.parquet(source)
    run = lambda: ingest(spark, source, rows.schema, lambda b: b, target, progress, ["k"], ["k"], files_per_batch=2)
    assert len([p for p in run().recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(target).count() == 40
    spark.createDataFrame([("q", "new"), ("q", "1")], rows.schema).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(target).count() == 41


def test_listed_files_misses_no_file(spark, monkeypatch):
    """A listing with one file left in each folder is not whole."""
    whole = files.list_files
    found = queries.listed_files(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 25 and all(r.Listed for r in found)

    def shortened(*args, **kwargs):
        rows = whole(*args, **kwargs)
        first = rows.groupBy(F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1)).agg(F.min("path").alias("path")).select("path")
        return rows.join(first, "path", "left_semi")

    monkeypatch.setattr(files, "list_files", shortened)
    assert not any(r.Listed for r in queries.listed_files(spark, "/root/testdata/sf0.01").collect())


def test_link_rows_are_read_in_one_step(spark):
    """Python is asked once for a page, and no pattern of a table's tags is left to Spark."""
    pages = spark.createDataFrame([("h", "c", 2020.1, LINK_PAGE)], "HashIndex string, CIK string, YearQuarter double, HTML string")
    plan = links.extract_links(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and not any(tag in plan for tag in ("<t[dh]", "<td", "<tr"))
    assert "rows" in links.cut_pages(pages, ["HashIndex"]).columns


def test_odd_link_tables(spark):
    """References, marks and end tags that a table should not hold are read as by the patterns that follow one another."""
    cells = [
        ("1", "a &lt; b&#65;&#x42;&#28;&bogus;&a;&#0099;", "1", "a < bAB�&bogus;&a;c"),
        ("2", "&amp;lt;&nbsp;x\x01\x1f\t \n y", "2", "&lt; x y"),
        ("3", "x<br>y<b title='<td>'>z</b>", "3", "x\nyz"),
        ("4<td/>", "p</td>", "4", None),
    ]
    body = "".join(f"<tr><td>{seq}</td><td>{text}</td><td>9</td></tr>" for seq, text, *_ in cells)
    page = f"<div id=formDiv><table><tr><th>Seq<th>Document<th>Size</tr>{body}</table></div>"
    found = links.extract_links(spark.createDataFrame([("h", "c", 2020.1, page)], "HashIndex string, CIK string, YearQuarter double, HTML string"))
    assert {(str(r.Seq), r.Document) for r in found.collect()} == {(seq, text) for *_, seq, text in cells}


def test_merge_moves_rows_once(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "YearQtr string, k string, v int, w string"
    first = [("q", "a", 2, "x"), ("q", None, 1, "x"), (None, "b", 1, "x"), ("s", "z", 1, "x")]
    tables.merge_new(spark, spark.createDataFrame(first, schema), path, ["k"], ["v"])
    again = [("q", "a", 1, "y"), ("q", None, 1, "y"), ("q", None, 0, "n"), (None, "b", 0, "y"), ("q", "c", 5, "y"), ("q", "c", 4, "n"), ("r", "a", 7, "y")]
    new = spark.createDataFrame(again, schema)
    found = tables.first_unknown(new, tables.touched(spark.read.parquet(path), new), ["YearQtr", "k"], ["v"])
    # Known keys meet the new rows in the shuffle that finds the first of each key, and copies drop out before it.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and plan.count("WindowGroupLimit") == 2
    # A null key is known to no table.
    added = [("q", None, 0, "n"), (None, "b", 0, "y"), ("q", "c", 4, "n"), ("r", "a", 7, "y")]
    assert sorted(map(tuple, found.select("YearQtr", "k", "v", "w").collect()), key=str) == sorted(added, key=str)
    tables.merge_new(spark, new, path, ["k"], ["v"], quarters=["q", "r"])
    merged = spark.read.parquet(path)
    assert sorted(map(tuple, merged.select("YearQtr", "k", "v", "w").collect()), key=str) == sorted(first + added, key=str)
    # One file for a small quarter in a run.
    files = merged.select("YearQtr", F.input_file_name()).distinct().groupBy("YearQtr").count()
    assert {r["YearQtr"]: r["count"] for r in files.collect()} == {"q": 2, "r": 1, "s": 1, None: 2}
    tables.merge_new(spark, new.filter("false"), path, ["k"], ["v"])
    assert spark.read.parquet(path).count() == 8


def test_many_copies_move_no_body(spark, tmp_path):
    """Far more copies than pages, and no room to broadcast their rows."""
    schema = "HashIndex string, CIK string, YearQuarter double, YearQtr string, HTML string, Error string, Status int"
    rows = [(f"h{k % 50}", "c", 2020.1, "2020-1", f"page {k % 50}", None, 200) for k in range(2000)]
    cut, limit = links.cut_table(spark.createDataFrame(rows, schema)), "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        pages = links.new_pages(spark, cut, str(tmp_path / "Pages"))
        assert sorted(r.HTML for r in pages.collect()) == sorted(f"page {k}" for k in range(50))
        plan = pages._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset(limit)


def test_marked_numbers_are_found(spark):
    numbers = [0, 1, 2, 7, 8, 32767, 32768, 32769, 65536, 1 << 33, (1 << 33) + 1, (5 << 33) + 40000]
    kept = spark.createDataFrame([(n,) for n in numbers], "n long")
    around = spark.createDataFrame([(n + d, "x") for n in numbers for d in (-1, 0, 1) if n + d >= 0], "n long, v string").distinct()
    found = keys.only_marked(around, keys.marked(kept, "n"), "n")
    assert found.columns == ["n", "v"] and sorted(r.n for r in found.collect()) == numbers
