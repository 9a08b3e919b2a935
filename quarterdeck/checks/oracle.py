"""SQL with the results of the queries, for DuckDB on the same tables."""

from __future__ import annotations

from html.entities import name2codepoint

from ..functions import html, text
from ..schemas import DOC_LINKS
from . import views

DATE = "strftime(o_orderdate, '%Y-%m-%d')"


def _str(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _digest(c: str) -> str:
    flags = f"CASE WHEN octet_length(encode({c})) = length({c}) THEN '00040009' ELSE '00008009' END"
    size = f"lpad(to_hex(octet_length(encode({c}))), 8, '0')"
    return f"md5(unhex('0000001000000001' || {flags} || {size}) || encode({c}))"


def _pad(c: str) -> str:
    return f"CASE WHEN length({c}) >= 10 THEN {c} ELSE lpad({c}, 10, '0') END"


def _label(c: str) -> str:
    return f"replace(CAST({c} AS VARCHAR), '.', '-')"


def _replace(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, {_str(pattern)}, {_str(by)}, 'g')"


_URL = "'https://www.sec.gov/Archives/data/' || o_custkey || '/' || o_orderkey"
FILINGS = f"""base AS (
  SELECT o_orderkey AS OrderKey, o_orderstatus AS Status, c_nationkey AS Nation, c_mktsegment AS Segment,
    CAST(year(o_orderdate) AS INTEGER) AS Year, CAST(quarter(o_orderdate) AS INTEGER) AS Quarter,
    {_pad("CAST(o_custkey AS VARCHAR)")} AS CIK, c_name AS CompanyName, o_orderpriority AS FormType,
    CAST(o_orderdate AS DATE) AS DateFiled, {_URL} || '.txt' AS UrlFullText, {_URL} || '-index.html' AS UrlIndexPage
  FROM orders JOIN customer ON o_custkey = c_custkey),
filings AS (
  SELECT {_digest("UrlIndexPage")} AS HashIndex, CAST(concat(Year, '.', Quarter) AS DOUBLE) AS YearQuarter,
    concat(Year, '-', Quarter) AS YearQtr, * FROM base)"""
INDEX_COLUMNS = (
    "HashIndex, Year, Quarter, YearQuarter, CIK, CompanyName, FormType, DateFiled, UrlFullText, UrlIndexPage"
)

_EXT = (
    "CASE l_linenumber WHEN 1 THEN '.htm' WHEN 2 THEN '.HTML' WHEN 3 THEN '.txt' WHEN 4 THEN '.xml' "
    "WHEN 5 THEN '.pdf' WHEN 6 THEN '.xsd' ELSE '' END"
)
ITEMS = FILINGS + f""",
items AS (
  SELECT HashIndex, CIK, YearQuarter, Status, l_linestatus AS LineStatus, l_discount AS Discount, OrderKey,
    l_linenumber AS Seq,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Complete submission text file'
      ELSE 'Part ' || l_partkey END AS Description,
    l_partkey || {_EXT} AS Document,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE l_returnflag || '-' || l_linestatus END AS Type,
    CAST(l_quantity AS BIGINT) AS Size,
    CASE WHEN l_linenumber = 1 THEN '/ix?doc=' ELSE '' END
      || '/Archives/data/' || l_orderkey || '/' || l_partkey || {_EXT} AS Href
  FROM lineitem JOIN filings ON l_orderkey = OrderKey),
hashed AS (SELECT *, {_digest("Href || '-' || Seq")} AS HashDocument, 'https://www.sec.gov' || Href AS UrlDocument FROM items),
links AS (SELECT *, CIK || '-' || HashDocument AS DocID FROM hashed)"""
LINK_COLUMNS = ", ".join(DOC_LINKS.fieldNames())

_LOOKUP = "(VALUES " + ", ".join(
    f"({', '.join(_str(v) for v in row)})" for row in views.FORM_LOOKUP
) + ") AS lk(FormType, FormClass, FormTypeMod, Description)"
FORM_TYPES = FILINGS + f""",
counts AS (SELECT FormType, count(*) AS nDocs FROM filings GROUP BY FormType),
form_types AS (SELECT FormClass, counts.FormType AS FormTypeRaw, FormTypeMod, nDocs, Description
  FROM counts LEFT JOIN {_LOOKUP} ON counts.FormType = lk.FormType)"""

_RULES = "(VALUES " + ", ".join(
    f"({i}, {_str(r.doc_class)}, {_str(r.regex)}, {_str(r.doc_type)}, {_str(r.description)})"
    for i, r in enumerate(views.DOC_RULES)
) + ") AS rules(pri, DocClass, rx, DocTypeMod, Description)"


def _doc_types(where: str) -> str:
    return ITEMS + f""",
doc_counts AS (SELECT CASE WHEN Type IS NULL AND Description = 'Complete submission text file'
    THEN 'Full Submission Text File' ELSE Type END AS T, count(*) AS nDocs FROM links {where} GROUP BY 1),
tested AS (SELECT T, nDocs, rules.*, regexp_matches(T, rx) AS hit FROM doc_counts, {_RULES}),
doc_types AS (SELECT min_by(CASE WHEN hit THEN DocClass END, CASE WHEN hit THEN pri END) AS DocClass, T AS DocTypeRaw,
    min_by(CASE WHEN hit THEN DocTypeMod END, CASE WHEN hit THEN pri END) AS DocTypeMod, nDocs,
    min_by(CASE WHEN hit THEN Description END, CASE WHEN hit THEN pri END) AS Description,
    CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS INTEGER) AS nHit
  FROM tested GROUP BY T, nDocs)"""


DOCS = _doc_types("") + f""",
typed AS (SELECT YearQuarter, DocTypeMod, DocID, replace(UrlDocument, '/ix?doc=/', '/') AS UrlDocument,
    {_label("YearQuarter")} AS YQSave, replace(replace(DocTypeMod, ' ', ''), '/', '') AS TypeSave,
    lower(regexp_extract(UrlDocument, '\\.([A-Za-z0-9]+)$', 1)) AS DocExt, LineStatus
  FROM links JOIN doc_types ON Type = DocTypeRaw WHERE nHit > 0),
docs AS (SELECT * EXCLUDE (LineStatus), LineStatus, concat_ws('/', 'Original', TypeSave, YQSave, DocID || '.' || DocExt) AS PathOrig,
    concat_ws('/', 'Parsed', TypeSave, YQSave, DocID || '.parquet') AS PathParse FROM typed WHERE DocExt <> ''),
pending AS (SELECT DISTINCT * EXCLUDE (LineStatus) FROM docs WHERE (TypeSave, YQSave, DocID) NOT IN (
    SELECT (TypeSave, YQSave, DocID) FROM docs WHERE DocExt = 'xml')),
numbered AS (SELECT *, row_number() OVER (PARTITION BY TypeSave, YQSave ORDER BY split_part(DocID, '-', 2), DocID) AS nRow,
    count(*) OVER (PARTITION BY TypeSave, YQSave) AS nAll FROM pending)"""
DOC_COLUMNS = "YearQuarter, DocTypeMod, DocID, UrlDocument, YQSave, TypeSave, DocExt, PathOrig, PathParse"


# Text


def _ascii(c: str) -> str:
    folded = f"translate({c}, {_str(text.FOLD_FROM)}, {_str(text.FOLD_TO)})"
    for sign, plain in text.FOLD_LONGER.items():
        folded = f"replace({folded}, {_str(sign)}, {_str(plain)})"
    return _replace(folded, r"([A-Za-z0-9])\p{Mn}+", r"\1")


def _standardize(c: str, o: text.StandardizeOptions = text.StandardizeOptions()) -> str:
    """The passes one after the other, as defined (the Spark side joins them where it can)."""
    passes = [
        (o.rm_html, "<[^>]*>"),
        (o.rm_punct, r"\p{P}"),
        (o.rm_num, r"\p{N}"),
        (o.rm_special, rf"[^\p{{L}}\p{{N}}{text.SPACE}]"),
        (o.rm_space, rf"[{text.SPACE}]+"),
    ]
    for wanted, pattern in passes:
        if wanted:
            c = _replace(c, pattern, " ")
    if o.to_ascii:
        c = _ascii(c)
    if o.to_upper:
        c = f"upper({c})"
    return f"trim({c})" if o.trim else c


_TAG = r"""<(/?[A-Za-z][A-Za-z0-9]*)(?:[^A-Za-z0-9>=][^>=]*)?(?:=\s*(?:"[^"]*"|'[^']*')?[^>=]*)*>"""


def _entities(c: str) -> str:
    names = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in sorted(name2codepoint.items())) + "}"
    ref = "regexp_extract(p, '^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});', 1)"
    code = (
        f"CASE WHEN {ref} = '' THEN NULL WHEN lower({ref}[1:2]) = '#x' THEN CAST('0x' || {ref}[3:] AS INTEGER) "
        f"WHEN {ref}[1:1] = '#' THEN TRY_CAST({ref}[2:] AS INTEGER) ELSE {names}[{ref}] END"
    )
    part = f"CASE WHEN i = 1 THEN p WHEN {code} IS NULL THEN '&' || p ELSE chr({code}) || regexp_replace(p, '^[^;]*;', '') END"
    return f"array_to_string(list_transform(string_split({c}, '&'), lambda p, i: {part}), '')"


def _layout(c: str) -> str:
    blocks = "|".join(html.BLOCKS.split())
    steps = [
        (html.UNSEEN_LAYOUT, ""),
        ("[ \t\r\n\f]+", " "),
        (_TAG, r"<\1>"),
        ("(?i)<br>", html.BREAK),
        ("(?i)(<tr> ?)<t[dh]>", r"\1"),
        ("(?i)<t[dh]>", html.CELL),
        ("(?i)</?p>", html.PARAGRAPH),
        (f"(?i)</?(?:{blocks})>", html.LINE),
        (html.OTHER_TAG, ""),
        (" +", " "),
        (f" *{html.CELL} *", html.CELL),
        (f"[{html.LINE} ]*{html.PARAGRAPH}[{html.LINE}{html.PARAGRAPH} ]*", "\n\n"),
        (f" *{html.LINE}[{html.LINE} ]*", "\n"),
        (f" *{html.BREAK} *", "\n"),
        (html.CELL, "\t"),
    ]
    for pattern, by in steps:
        c = _replace(c, pattern, by)
    return f"trim({c}, ' \n')"


def _page_text(source: str) -> str:
    """CTEs from ``source`` (Id, html) to ``texts`` (Id, html, T)."""
    plain = _replace(_replace("html", html.UNSEEN, ""), f"{_TAG}|{html.OTHER_TAG}", "")
    ratio = f"len(regexp_extract_all(html, {_str(html.RAW_SPACE)})) / length(html)"
    return f"""pages_in AS ({source}),
marked AS (SELECT *, {ratio} > {html.RAW_SPACE_LIMIT} AS is_plain FROM pages_in),
laid AS (SELECT *, CASE WHEN is_plain THEN {plain} ELSE {_layout("html")} END AS M FROM marked),
decoded AS (SELECT *, {_entities("M")} AS D FROM laid),
texts AS (SELECT Id, html, CASE WHEN is_plain THEN D ELSE replace(D, chr(160), ' ') END AS T FROM decoded)"""


# Landing pages

LANDED = FILINGS + """,
landed AS (SELECT *, ltrim(CIK, '0') AS RawCik FROM filings WHERE NOT (Status = 'O' AND FormType = '1-URGENT')),
cik AS (SELECT *, CASE WHEN RawCik = '' THEN '0000000000' ELSE CIK END AS C FROM landed)"""


def _union(*rows: str, source: str = "cik") -> str:
    return " UNION ALL ".join(f"SELECT HashIndex, {row} FROM {source}" for row in rows)


def _entry(kind: str, num: int, name: str, info: str) -> str:
    return f"{_str(kind)} AS Kind, {num} AS EntryNum, {_str(name)} AS Name, {info} AS Info"


GROUPING = _union(
    _entry("formName", 1, "Current Report", "'Form ' || FormType || ' - Report:'"),
    _entry("secNum", 1, "Accession Number", "CAST(OrderKey AS VARCHAR)"),
    _entry("formGrouping", 1, "Filing Date", "CAST(DateFiled AS VARCHAR)"),
    _entry("formGrouping", 1, "Accepted", "CAST(DateFiled AS VARCHAR)"),
    _entry("formGrouping", 1, "Lead & Part.", "Segment"),
)
COMPANY = _union(
    _entry("mailer", 1, "Mailing Address", "Nation || ' Main St' || chr(10) || 'City ' || Nation"),
    _entry("mailer", 1, "Business Address", "Nation || ' High St'"),
    _entry("companyName", 1, "CompanyName", "CompanyName"),
    _entry("companyName", 1, "CIK", "C"),
) + " UNION ALL " + _union(
    _entry("companyName", 2, "CompanyName", "'Partner ' || OrderKey || ' (Subject) CIK'"),
    _entry("companyName", 2, "CIK", "C"),
    source="cik WHERE Status = 'O'",
)
IDENT = _union(
    _entry("identInfo", 1, "IRS No.", "CAST(OrderKey AS VARCHAR)"),
    _entry("identInfo", 1, "State of Incorp.", "'N' || Nation"),
    _entry("identInfo", 1, "Fiscal Year End", "'1231'"),
    _entry("identInfo", 1, "Type", "FormType"),
    _entry("identInfo", 1, "Act", "'34'"),
    _entry("identInfo", 1, "File No.", "'001:' || OrderKey"),
    _entry("identInfo", 1, "SIC", "CAST(Nation AS VARCHAR)"),
) + " UNION ALL " + _union(
    _entry("identInfo", 2, "State of Incorp.", "'X' || Nation"), source="cik WHERE Status = 'O'"
)

_NONE = ["Documents", "PeriodOfReport", "FilingDateChanged", "EffectivenessDate", "Items", "FilmNo"]


def _pivot(entry: int, company: str, state: str, where: str) -> str:
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NONE)
    return f"""SELECT HashIndex, {entry} AS EntryNum, CAST(DateFiled AS VARCHAR) AS FilingDate,
  CAST(DateFiled AS VARCHAR) AS Accepted, {nulls}, 'Form ' || FormType || ' - Report:' AS CurrentReport,
  CAST(OrderKey AS VARCHAR) AS AccessionNumber, Nation || ' Main St' || chr(10) || 'City ' || Nation AS MailingAddress,
  Nation || ' High St' AS BusinessAddress, {company} AS CompanyName, C AS Cik, CAST(OrderKey AS VARCHAR) AS IrsNo,
  {state} || Nation AS StateOfIncorp, '1231' AS FiscalYearEnd, FormType AS Type, '34' AS Act, '001:' || OrderKey AS FileNo,
  CAST(Nation AS VARCHAR) AS Sic, 'LeadPart=' || Segment AS Other, 0 AS Error, 'Success: All Elements Parsed' AS Message
  FROM cik {where}"""


_ALL_NULL = ", ".join(
    f"NULL AS {c}" for c in (
        "FilingDate Accepted " + " ".join(_NONE) + " CurrentReport AccessionNumber MailingAddress BusinessAddress "
        "CompanyName Cik IrsNo StateOfIncorp FiscalYearEnd Type Act FileNo Sic Other"
    ).split()
)
LANDING = (
    _pivot(1, "CompanyName", "'N'", "")
    + " UNION ALL "
    + _pivot(2, "'Partner ' || OrderKey || ' (Subject) CIK'", "'X'", "WHERE Status = 'O'")
    + f""" UNION ALL SELECT HashIndex, NULL AS EntryNum, {_ALL_NULL}, 1 AS Error, 'Error: No HTML Supplied' AS Message
  FROM filings WHERE Status = 'O' AND FormType = '1-URGENT'"""
)

ANCHORS = r"""found AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"', 1) AS h FROM pages),
anchors AS (SELECT page_id, url, unnest(h) AS Href, CAST(generate_subscripts(h, 1) AS INTEGER) AS Seq,
    regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS Origin,
    regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS Folder FROM found)"""

RESPONSES = """responses AS (SELECT event_id AS ResponseId, CASE WHEN event_type = 'error' THEN 'Timeout was reached' END AS Error,
    CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 204 WHEN 'purchase' THEN 404 WHEN 'signup' THEN 302 END AS Status
  FROM events)"""

PERIODS = FILINGS + """,
ends AS (SELECT min(Year * 4 + Quarter - 1) AS a, max(Year * 4 + Quarter - 1) AS b FROM filings),
idx AS (SELECT unnest(range(a, b + 1)) AS i FROM ends),
yq AS (SELECT CAST(i // 4 AS INTEGER) AS Year, CAST(i % 4 + 1 AS INTEGER) AS Quarter FROM idx),
grid AS (SELECT *, CAST(concat(Year, '.', Quarter) AS DOUBLE) AS YearQuarter, concat(Year, '-', Quarter) AS YearQtrSave FROM yq)"""

_ALL = text.StandardizeOptions(rm_num=True, rm_html=True)
_KEPT = text.StandardizeOptions(rm_punct=False, to_upper=False, rm_html=True)

DOC_LINK_TABLE = f"""WITH {ITEMS}, whole AS (SELECT HashIndex, CIK, YearQuarter, OrderKey,
            '/Archives/data/' || OrderKey || '.txt' AS h FROM links),
        hashed2 AS (SELECT *, {_digest("h || '-NA'")} AS d FROM whole)
        SELECT {LINK_COLUMNS} FROM links
        UNION ALL SELECT HashIndex, CIK, CIK || '-' || d, d, YearQuarter, -1, 'Complete submission text file',
          OrderKey || '.txt', NULL, -1, 'https://www.sec.gov' || h FROM hashed2"""

ORACLE: dict[str, str] = {
    "filings_scan": f"WITH {FILINGS} SELECT {INDEX_COLUMNS} FROM filings WHERE FormType = '1-URGENT' AND Quarter = 4",
    "read_filings": f"""WITH {FILINGS} SELECT {INDEX_COLUMNS} FROM filings
        WHERE YearQuarter BETWEEN 1996.2 AND 1999.3 AND FormType IN ('1-URGENT', '3-MEDIUM') AND Segment = 'BUILDING'""",
    "filing_ids": f"WITH {FILINGS} SELECT {INDEX_COLUMNS}, YearQtr AS YearQtrSave FROM filings",
    "master_index_parse": f"""WITH {FILINGS} SELECT {INDEX_COLUMNS} FROM filings
        WHERE Segment <> 'MACHINERY' AND Year <> 1995""",
    "master_index_quarantine": f"""WITH {FILINGS},
        bad AS (SELECT concat('/raw/full-index/', Year, '/QTR', Quarter, '/master.idx') AS file,
            CASE WHEN Year = 1995 THEN 'Unexpected Header' ELSE 'Unexpected Number of Fields' END AS Reason
          FROM filings WHERE Year = 1995 OR Segment = 'MACHINERY'
          UNION ALL SELECT DISTINCT concat('/raw/full-index/', Year, '/QTR', Quarter, '/master.idx'), 'Unexpected Header'
          FROM filings WHERE Year = 1995)
        SELECT file, Reason, count(*) AS nLines FROM bad GROUP BY file, Reason""",
    "period_bounds": f"WITH {FILINGS} SELECT min(YearQuarter) AS FirstPeriod, max(YearQuarter) AS LastPeriod FROM filings",
    "period_grid": f"""WITH {PERIODS}, n AS (SELECT Year, Quarter, count(*) AS k FROM filings GROUP BY ALL)
        SELECT grid.*, concat('https://www.sec.gov/Archives/edgar/full-index/', grid.Year, '/QTR', grid.Quarter, '/master.idx') AS UrlMasterIndex,
          concat('MasterIndex/', YearQtrSave, '.parquet') AS PathOut, coalesce(k, 0) AS nFilings
        FROM grid LEFT JOIN n ON n.Year = grid.Year AND n.Quarter = grid.Quarter""",
    "pending_periods": f"""WITH {PERIODS} SELECT * FROM grid WHERE YearQtrSave NOT IN
        (SELECT YearQtr FROM filings WHERE DateFiled < DATE '1999-01-01')""",
    "selected_filings": f"WITH {FILINGS} SELECT {INDEX_COLUMNS} FROM filings WHERE Status = 'F'",
    "pending_filings": f"WITH {FILINGS} SELECT {INDEX_COLUMNS} FROM filings WHERE Status <> 'F'",
    "processed_filter": f"WITH {FILINGS} SELECT {INDEX_COLUMNS} FROM filings WHERE Status <> 'F'",
    "distinct_filings": f"WITH {FILINGS} SELECT DISTINCT CIK, FormType FROM filings",
    "work_batches": f"""WITH {FILINGS} SELECT CAST(ceil(row_number() OVER (PARTITION BY YearQuarter, FormType
            ORDER BY HashIndex) / 10.0) AS BIGINT) AS Seq, YearQtr AS YearQtrSave,
          regexp_replace(FormType, '[-/]', '', 'g') AS FormTypeSave, HashIndex, CIK, FormType, YearQuarter, UrlIndexPage
        FROM filings WHERE Status <> 'F'""",
    "page_links": f"""WITH {ANCHORS} SELECT page_id, Seq, Href, Origin || Href AS UrlDocument,
          lpad(CAST(page_id AS VARCHAR), 10, '0') || '-' || {_digest("Href || '-' || Seq")} AS DocID FROM anchors""",
    "url_absolute": f"""WITH {ANCHORS} SELECT page_id, Seq, Origin || Href AS UrlRoot, Folder || Href[2:] AS UrlRelative,
          CASE WHEN Folder = Origin || '/' THEN Folder ELSE regexp_replace(Folder, '[^/]+/$', '') END || Href[2:] AS UrlParent,
          regexp_extract(url, '^[a-z]+:', 0) || '//other.example.com' || Href AS UrlHost, 'ftp://h' || Href AS UrlWhole
        FROM anchors""",
    "url_parts": f"""WITH {ITEMS}, e AS (SELECT *, regexp_extract(UrlDocument, '\\.([A-Za-z0-9]+)$', 1) AS x FROM links)
        SELECT DocID, UrlDocument, lower(x) AS DocExt,
          CASE WHEN x IN ('html', 'htm', 'xml', 'xsd', 'txt') THEN 'text' ELSE 'raw' END AS ContentClass,
          contains(UrlDocument, 'ix?doc=') AS IsViewer, replace(UrlDocument, '/ix?doc=/', '/') AS UrlPlain,
          concat_ws('/', 'Original', {_label("YearQuarter")}, Document) AS PathOrig FROM e""",
    "doc_link_table": DOC_LINK_TABLE,
    "links_job": f"""SELECT * FROM ({DOC_LINK_TABLE}) QUALIFY row_number() OVER (PARTITION BY DocID
          ORDER BY Seq, UrlDocument, Description, Document, Type NULLS FIRST, Size) = 1""",
    "index_job": f"""WITH {FILINGS} SELECT {INDEX_COLUMNS}, YearQtr FROM filings
        WHERE Segment <> 'MACHINERY' AND Year <> 1995""",
    "read_links": f"""WITH {_doc_types("")} SELECT {LINK_COLUMNS} FROM links WHERE YearQuarter >= 1997.1
        AND HashIndex IN (SELECT HashIndex FROM filings WHERE FormType = '2-HIGH')
        AND Type IN (SELECT DocTypeRaw FROM doc_types WHERE DocTypeMod = 'Type A')""",
    "clean_columns": """SELECT l_orderkey AS OrderKey, l_partkey AS PartKey,
          CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE -1 END AS Seq,
          CAST(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE -1 END AS BIGINT) AS Size, l_returnflag AS Type,
          CASE WHEN l_linestatus <> 'F' THEN l_linestatus END AS Description, CAST(l_suppkey AS VARCHAR) AS Document
        FROM lineitem""",
    "pages_with_keys": f"""WITH {FILINGS} SELECT HashIndex, CASE WHEN Status <> 'P' THEN CIK END AS CIK,
          CASE WHEN Status <> 'P' THEN YearQuarter END AS YearQuarter, '<p>' || OrderKey || '</p>' AS HTML FROM filings""",
    "landing_grouping": f"WITH {LANDED} {GROUPING}",
    "landing_company": f"WITH {LANDED} {COMPANY}",
    "landing_ident": f"WITH {LANDED} {IDENT}",
    "landing_pivot": f"WITH {LANDED} {LANDING}",
    "attribute_pivot": """WITH f AS (SELECT user_id, event_type, arg_min(coalesce(value::VARCHAR, 'null'), row(ts, event_id)) AS v FROM events GROUP BY ALL)
        SELECT user_id AS Entity, nullif(max(CASE WHEN event_type = 'view' THEN v END), 'null')::DOUBLE AS FirstView,
          nullif(max(CASE WHEN event_type = 'click' THEN v END), 'null')::DOUBLE AS FirstClick,
          nullif(max(CASE WHEN event_type = 'error' THEN v END), 'null')::DOUBLE AS FirstError,
          CAST(count(*) FILTER (event_type NOT IN ('view', 'click')) AS INTEGER) AS nOther FROM f GROUP BY user_id""",
    "entry_numbers": """SELECT user_id AS Entity, event_id AS EventId, event_type AS Name,
          row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS EntryNum FROM events""",
    "fill_down": """SELECT user_id AS Entity, event_id AS EventId,
          last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER w AS ViewInfo,
          last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER w AS ErrorInfo FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "docs_by_type": f"""WITH {DOCS} SELECT {DOC_COLUMNS} FROM docs
        WHERE DocID IN (SELECT DocID FROM links WHERE LineStatus = 'F')""",
    "pending_documents": f"WITH {DOCS} SELECT {DOC_COLUMNS} FROM pending",
    "nest_documents": f"""WITH {DOCS} SELECT TypeSave, YQSave, (nRow + 99) // 100 AS Chunk, CAST(count(*) AS INTEGER) AS nDocs,
          string_agg(DocID || ' ' || UrlDocument, ',' ORDER BY nRow) AS Docs FROM numbered GROUP BY ALL""",
    "group_progress": f"""WITH {DOCS} SELECT TypeSave, YQSave, DocID, nRow, nAll,
          concat(TypeSave, ': ', YQSave, ' (', format('{{:,}}', nRow), '/', format('{{:,}}', nAll), ')') AS Print FROM numbered""",
    "parse_documents": f"""WITH {_page_text("SELECT page_id AS Id, html FROM pages")},
        files AS (SELECT concat('d', doc_id) AS DocID, text AS HTML, text AS TextRaw, 'txt' AS DocExt FROM documents
          UNION ALL SELECT concat('p', Id), html, T, 'htm' FROM texts)
        SELECT DocID, HTML, TextRaw, {_standardize("TextRaw")} AS TextMod, DocExt, FALSE AS ErrParse,
          CAST(NULL AS VARCHAR) AS MsgParse FROM files
        UNION ALL SELECT concat('z', page_id), NULL, NULL, NULL, 'zip', TRUE, 'zip is not supported' FROM pages""",
    "documents_job": f"""WITH {_page_text("SELECT page_id AS Id, html FROM pages")},
        files AS (SELECT doc_id AS n, concat('d', doc_id) AS DocID, text AS HTML, text AS TextRaw, 'txt' AS DocExt, 'Text' AS TypeSave FROM documents
          UNION ALL SELECT Id, concat('p', Id), html, T, 'htm', 'WebPage' FROM texts),
        parsed AS (SELECT n, DocID, HTML, TextRaw, {_standardize("TextRaw")} AS TextMod, DocExt, FALSE AS ErrParse,
            CAST(NULL AS VARCHAR) AS MsgParse, TypeSave FROM files
          UNION ALL SELECT page_id, concat('z', page_id), NULL, NULL, NULL, 'zip', TRUE, 'zip is not supported', 'Other' FROM pages)
        SELECT * EXCLUDE (n), concat(2000 + n % 3, '-', n % 4 + 1) AS YQSave FROM parsed""",
    "list_files": """WITH p AS (SELECT regexp_replace(url, '[?#].*$', '') AS path FROM pages)
        SELECT regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]*$', '') AS doc_id, path
        FROM p WHERE regexp_matches(path, '\\.html?$')""",
    "listed_files": "SELECT DISTINCT c_nationkey AS Nation, TRUE AS Listed FROM customer",
    "resolve_doc_types": f"""WITH {_doc_types("")},
        wanted AS (SELECT DISTINCT 'Type ' || l_returnflag AS m FROM lineitem UNION SELECT 'Type ' || l_linestatus FROM lineitem),
        known AS (SELECT DISTINCT DocTypeMod, DocTypeRaw FROM doc_types WHERE nHit > 0)
        SELECT DocTypeMod, DocTypeRaw, CAST(NULL AS VARCHAR) AS Missing FROM wanted JOIN known ON m = DocTypeMod
        UNION ALL SELECT NULL, NULL, string_agg(m, ', ' ORDER BY m) FROM wanted WHERE m NOT IN (SELECT DocTypeMod FROM known)""",
    "standardize_text": f"SELECT doc_id, {_standardize('text')} AS TextMod FROM documents",
    "standardize_text_all": f"""SELECT page_id, {_standardize("html", _ALL)} AS TextAll,
          {_standardize("html", _KEPT)} AS TextKept FROM pages""",
    "standardize_string": f"""SELECT doc_id, trim({_ascii(_replace("text", f"[{text.SPACE}|]+", " "))}, ' \t\r\n') AS TextMod
        FROM documents""",
    "html_to_text": f"WITH {_page_text('SELECT page_id AS Id, html FROM pages')} SELECT Id AS page_id, T AS TextRaw FROM texts",
    "html_to_text_plain": "WITH "
    + _page_text("SELECT page_id AS Id, replace(html, ' ', chr(10) || chr(9) || ' ') AS html FROM pages")
    + " SELECT Id AS page_id, T AS TextRaw FROM texts",
    "whitespace_ratio": f"""WITH c AS (SELECT 'page' AS Kind, page_id AS Id, html AS c FROM pages
          UNION ALL SELECT 'document', doc_id, text FROM documents)
        SELECT Kind, Id, len(regexp_extract_all(c, {_str(html.RAW_SPACE)})) / length(c) AS Ratio FROM c""",
    "form_type_counts": f"WITH {FILINGS} SELECT FormType, count(*) AS nDocs FROM filings GROUP BY FormType",
    "form_types_raw": f"WITH {FORM_TYPES} SELECT * FROM form_types",
    "form_types_mod": f"""WITH {FORM_TYPES} SELECT FormClass, FormTypeMod, CAST(sum(nDocs) AS BIGINT) AS nDocs, Description
        FROM form_types GROUP BY FormClass, FormTypeMod, Description""",
    "unmapped_types": f"WITH {FORM_TYPES} SELECT DISTINCT FormTypeRaw FROM form_types WHERE FormTypeMod IS NULL",
    "doc_type_classify": f"WITH {_doc_types('WHERE NOT Discount > 0.08')} SELECT * FROM doc_types",
    "doc_types_mod": f"""WITH {_doc_types("WHERE NOT Discount > 0.08")}
        SELECT DocClass, DocTypeMod, CAST(sum(nDocs) AS BIGINT) AS nDocs, Description
        FROM doc_types GROUP BY DocClass, DocTypeMod, Description""",
    "dedupe_first": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey,
          l_quantity, l_discount, l_tax, l_shipdate) = 1""",
    "union_sources": """SELECT c_custkey AS Key, c_name AS Name, c_mktsegment AS Segment, 'customer' AS Source,
          CAST(NULL AS INTEGER) AS Nation FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier', s_nationkey FROM supplier""",
    "partitioned_sink": f"""WITH {FILINGS} SELECT {INDEX_COLUMNS.replace("CompanyName", "CASE WHEN Year < 1998 THEN CompanyName ELSE upper(CompanyName) END AS CompanyName")},
          YearQtr FROM filings""",
    "upsert_keep_existing": f"""WITH {ITEMS}, both_ AS (SELECT {LINK_COLUMNS}, 0 AS p FROM links WHERE LineStatus = 'F'
          UNION ALL SELECT {LINK_COLUMNS.replace("Description", "'New ' || Description AS Description")}, 1 FROM links)
        SELECT {LINK_COLUMNS} FROM both_ QUALIFY row_number() OVER (PARTITION BY DocID
          ORDER BY p, Seq, UrlDocument, Description, Document, Type NULLS FIRST, Size) = 1""",
    "incremental_stream": f"WITH {FILINGS} SELECT {INDEX_COLUMNS}, YearQtr FROM filings",
    "quarantine_status": f"""WITH {RESPONSES}, r AS (SELECT *, CASE WHEN Error IS NOT NULL THEN Error
            WHEN Status IS NULL OR Status NOT BETWEEN 200 AND 299 THEN concat('Status Code (', coalesce(CAST(Status AS VARCHAR), 'NA'), ')')
            END AS Reason FROM responses)
        SELECT CASE WHEN Reason IS NULL THEN 'valid' ELSE 'quarantine' END AS Part, ResponseId, Status, Error, Reason FROM r""",
    "quarantine_content": """WITH c AS (SELECT doc_id, lang = 'es' OR source = 'src1' AS bad,
          CASE WHEN lang = 'es' THEN ' ' || chr(10) WHEN source <> 'src1' THEN text END AS Content FROM documents)
        SELECT CASE WHEN bad THEN 'quarantine' ELSE 'valid' END AS Part, doc_id, Content,
          CASE WHEN bad THEN 'Content is Empty' END AS Reason FROM c""",
    "empty_outputs": f"""WITH {FILINGS}, k AS (SELECT {_pad("CAST(c_custkey AS VARCHAR)")} AS CIK FROM customer),
        n AS (SELECT CIK, count(*) AS r FROM filings WHERE Year = 1998 GROUP BY CIK)
        SELECT k.CIK, coalesce(r, 0) AS nRows, CASE WHEN r IS NULL THEN 'Output Table has 0 Rows' END AS Reason
        FROM k LEFT JOIN n ON k.CIK = n.CIK""",
    "run_metrics": f"""WITH {ITEMS} SELECT {_label("YearQuarter")} AS YearQtrSave, count(*) AS nRows,
          count(DISTINCT HashIndex) AS nFilings, CAST(sum(Size) AS BIGINT) AS TotalSize, min(Size) AS MinSize,
          max(Size) AS MaxSize, arg_min(DocID, HashIndex || DocID) AS FirstDoc FROM links GROUP BY 1""",
    "run_log": f"""WITH {PERIODS}, last AS (SELECT YearQtr, max(DateFiled) AS d FROM filings GROUP BY 1),
        n AS (SELECT YearQtr, count(*) AS r FROM filings WHERE FormType = '1-URGENT' AND Quarter <> 2 GROUP BY 1)
        SELECT CAST(d AS VARCHAR) || ' 00:00:00' AS Timestamp, CASE WHEN r IS NULL THEN 'ERROR' ELSE 'INFO' END AS Level,
          CASE WHEN r IS NULL THEN 'Error Occurred: Output Table has 0 Rows, continuing ...'
            ELSE 'Downloaded Year-Quarter: ' || YearQtrSave END AS Message,
          CASE WHEN r IS NULL THEN 'Empty table' ELSE 'Rows: ' || r END AS Details
        FROM grid JOIN last ON YearQtrSave = last.YearQtr LEFT JOIN n ON YearQtrSave = n.YearQtr""",
}
