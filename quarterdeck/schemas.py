"""Table schemas of the pipeline, and the fixed values the tables are built with."""

from __future__ import annotations

from pyspark.sql import types as T

# Archive addresses, index layout, default first period.
ARCHIVE_BASE = "https://www.sec.gov/Archives/"
INDEX_ROOT = "https://www.sec.gov/Archives/edgar/full-index"
INDEX_FILE = "master.idx"
INDEX_HEADER = ["CIK", "Company Name", "Form Type", "Date Filed", "Filename"]
FIRST_YEAR = 1993
FIRST_PERIOD = 1993.1
BATCH_SIZE = 10

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


PERIOD_GRID = _table(("Year", _I), ("Quarter", _I), ("YearQuarter", _D), ("YearQtrSave", _S))

MASTER_INDEX = _table(
    ("HashIndex", _S), ("Year", _I), ("Quarter", _I), ("YearQuarter", _D), ("CIK", _S),
    ("CompanyName", _S), ("FormType", _S), ("DateFiled", T.DateType()), ("UrlFullText", _S),
    ("UrlIndexPage", _S),
)

WORK_QUEUE = _table(
    ("Seq", _L), ("YearQtrSave", _S), ("FormTypeSave", _S), ("HashIndex", _S), ("CIK", _S),
    ("FormType", _S), ("YearQuarter", _D), ("UrlIndexPage", _S),
)

PAGES = _table(("HashIndex", _S), ("CIK", _S), ("YearQuarter", _D), ("HTML", _S))

DOC_LINKS = _table(
    ("HashIndex", _S), ("CIK", _S), ("DocID", _S), ("HashDocument", _S), ("YearQuarter", _D),
    ("Seq", _I), ("Description", _S), ("Document", _S), ("Type", _S), ("Size", _L),
    ("UrlDocument", _S),
)

PARSED_DOCUMENT = _table(
    ("DocID", _S), ("HTML", _S), ("TextRaw", _S), ("TextMod", _S), ("DocExt", _S),
    ("ErrParse", T.BooleanType()), ("MsgParse", _S),
)

RUN_LOG = _table(("Timestamp", _S), ("Level", _S), ("Message", _S), ("Details", _S))
