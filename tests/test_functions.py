from datetime import date

from pyspark.sql import functions as F

from quarterdeck.functions import clean, fragments, html, ids, names, text, urls


def one(spark, column, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column).first()[0]


def each(spark, build, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("c"))).collect()]


def test_ids(spark):
    assert each(spark, ids.pad_cik, ["320193", "12345678901", None]) == ["0000320193", "12345678901", None]
    assert each(spark, ids.digest_id, ["a", None]) == ["127a2ec00989b9f7faf671ed470be7f8", None]
    assert each(spark, ids.parse_date, ["2020-01-31", "20200131", "2020-02-31", "soon", None]) == [
        date(2020, 1, 31), date(2020, 1, 31), None, None, None,
    ]
    assert one(spark, ids.label_from_number(F.lit(2023.1)), "x") == "2023-1"


def test_urls(spark):
    base = "https://h.com/a/b/c?x=1"
    cases = {
        "d.htm": "https://h.com/a/b/d.htm", "/d": "https://h.com/d", "//o/d": "https://o/d", "http://o/": "http://o/",
        "../d": "https://h.com/a/d", "./d/../e": "https://h.com/a/b/e", "?y": "https://h.com/a/b/c?y", "": base,
        "../../../d": "https://h.com/d",
    }
    assert each(spark, lambda c: urls.url_absolute(c, base), list(cases)) == list(cases.values())
    assert each(spark, urls.file_extension, ["x/y.HTM", "x.tar.gz", "x", "a.b/c"]) == ["htm", "gz", "", ""]
    assert each(spark, urls.strip_extension, ["a/b.txt", "a/.x", "a.b/c"]) == ["a/b", "a/.x", "a.b/c"]
    assert each(spark, urls.base_name, ["a/b.txt", "a/.x", "b"]) == ["b", ".x", "b"]
    assert each(spark, urls.unwrap_viewer, ["https://h/ix?doc=/A/x.htm", "https://h/A/x.htm"]) == ["https://h/A/x.htm"] * 2


def test_names(spark):
    raw = ["IRS No.", "CompanyName", "State of Incorp.", "CIK", "Fiscal Year End:"]
    assert each(spark, names.upper_camel, raw) == ["IrsNo", "CompanyName", "StateOfIncorp", "Cik", "FiscalYearEnd"]


def test_standardize(spark):
    raw = "  Straße &  “Æsir”\t5% naïve "
    assert one(spark, text.standardize_text(F.col("c0")), raw) == "STRASSE AESIR 5 NAIVE"
    o = text.StandardizeOptions(rm_punct=False, rm_special=False, to_upper=False, rm_num=True)
    assert one(spark, text.standardize_text(F.col("c0"), o), raw) == 'Strasse & "AEsir" % naive'
    assert one(spark, text.standardize_string(F.col("c0")), " a||b\n é ") == "a b e"


def test_standardize_passes_agree_with_joined_pass(spark):
    raw = "x-1  y_ź ½<b>q</b>—"
    c = F.col("c0")
    for pattern in (r"\p{P}", rf"[^\p{{L}}\p{{N}}{text.SPACE}]", rf"[{text.SPACE}]+"):
        c = F.regexp_replace(c, pattern, " ")
    expected = one(spark, F.trim(F.upper(text.to_ascii(c))), raw)
    assert one(spark, text.standardize_text(F.col("c0")), raw) == expected


def test_clean_columns(spark):
    rows = [(" 7 ", "12", " a\t"), ("", None, " \r\n"), ("x", "1.9", None), ("99999999999", "5000000000", "b")]
    df = clean.clean_columns(spark.createDataFrame(rows, "Seq string, Size string, T string"), {"Seq": "int", "Size": "bigint"}, ["T"])
    assert [tuple(r) for r in df.collect()] == [(7, 12, "a"), (-1, -1, None), (-1, 1, None), (-1, 5000000000, "b")]


def page_text(spark, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string")
    return [r.t for r in html.add_html_text(df, "h", "t").orderBy("i").collect()]


def test_layout(spark):
    source = (
        "<html><head><title>T</title><style>p{}</style></head><body><h1>Hi &amp; you</h1><!-- x --><p>a\n  b<br>c</p>"
        "<p title='x>y'>d&nbsp;e &#8217; &#x41; &bogus; &amp;lt; &eacute;</p><table><TR><td>1</td> <td>2</td></tr>"
        "<tr><td>3<td>4</table><pre> x\n  y</pre><script>if(a<b)</script>tail"
    )
    assert page_text(spark, source, "", None, "<b>x</b> <i>y</i>") == [
        "Hi & you\n\na b\nc\n\nd e ’ A &bogus; &lt; é\n\n1\t2\n3\t4\n x\n  y\ntail", None, None, "x y",
    ]


def test_plain_mode_and_ratio(spark):
    assert page_text(spark, "a\t\t\t\n\n<b>x</b>&nbsp;y") == ["a\t\t\t\n\nx y"]
    assert each(spark, html.whitespace_ratio, ["a\tb&#10;", "", None]) == [2 / 8, None, None]


def test_entities(spark):
    raw = ["&amp;amp;", "&lt;&#60;&#x3C;", "a & b; &c", "&#0;&#1114112;&#128512;", "no", "&mdash;&Alpha;&lt"]
    assert each(spark, html.decode_entities, raw) == ["&amp;", "<<<", "a & b; &c", "��\U0001f600", "no", "—Α&lt"]


def test_broken_tags_are_linear(spark):
    attributes = 'a="1" ' * 3000
    assert page_text(spark, f"<p>ok</p><table {attributes}")[0].startswith("ok")


def test_references_of_any_length(spark):
    cases = {
        "&apos;": "'", "&#0000000039;": "'", "&#x0000027;": "'", "&#99999999999;": "\ufffd", "&#xfffffffff;": "\ufffd",
        "&thetasym;": "\u03d1", "&unknownreference;": "&unknownreference;", "a & b; c": "a & b; c",
    }
    assert each(spark, html.decode_entities, list(cases)) == list(cases.values())


def test_tags_with_many_attributes_keep_their_layout(spark):
    cell = "<table><tr><td>x<td " + " ".join(f"a{i}='>'" for i in range(2000)) + ">y</table>"
    page = spark.createDataFrame([(cell,)], "html string")
    assert html.add_html_text(page, "html", "text").first().text == "x\ty"


def test_whole_numbers_of_any_length(spark):
    values = ["1234567890123456789", "-9223372036854775808", "9223372036854775808", "12.9", "x", "", None, " +7 "]
    assert each(spark, lambda c: clean.to_integer(c, "bigint"), values) == [1234567890123456789, -(2**63), None, 12, None, None, None, 7]
    assert each(spark, clean.to_integer, ["2147483648", "2147483647"]) == [None, 2147483647]


def test_letters_without_a_decomposition(spark):
    raw = "\u0132\u0133 \u01c4\u01c6 \u0253\u0256 \uff21\uff41"
    assert one(spark, text.to_ascii(F.col("c0")), raw) == "IJij DZdz bd Aa"


def test_undecodable_bytes_are_null(spark):
    from quarterdeck.sources.files import decode_text

    rows = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"a\xff"),), (None,)], "b binary")
    for name, wanted in {"US-ASCII": ["ok", None, None], "latin-1": ["ok", "aÿ", None], "UTF-8": ["ok", "a�", None], "shift_jis": ["ok", None, None]}.items():
        assert [r[0] for r in rows.select(decode_text(F.col("b"), name)).collect()] == wanted, name


def test_start_tags_are_read_once(monkeypatch):
    read, whole = [], fragments._selectors
    monkeypatch.setattr(fragments, "_selectors", lambda attributes: read.append(attributes) or whole(attributes))
    monkeypatch.setattr(fragments, "_KNOWN_TAGS", 8)
    cutter = fragments.Cutter([("k", ".box", ".x"), ("t", None, "table")])
    page = "<div class='box'><i class=x>1</i><I CLASS=x>2</I></div><table><tr><td>3</table>"
    cut = [("k", "1"), ("k", "2"), ("t", "<tr><td>3")]
    for _ in range(50):
        assert [(piece["kind"], piece["html"]) for piece in cutter.cut(page)] == cut
    assert len(read) == 4
    # However many there are, only some are kept.
    for k in range(50):
        assert [piece["html"] for piece in cutter.cut(f"<p id=p{k} class='box'><b class='x b{k}'>{k}</b></p>")] == [str(k)]
        assert len(cutter.known) <= 8
