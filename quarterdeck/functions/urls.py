"""URL and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions fetched and parsed as text.
TEXT_EXTENSIONS = ["txt", "htm", "html", "xml", "xsd"]
HTML_EXTENSIONS = ["htm", "html"]

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def _without_dots(url: Column) -> Column:
    """Resolve "." and ".." path segments, leaving query and fragment alone."""
    origin = F.regexp_extract(url, _ORIGIN, 1)
    path = F.regexp_extract(url, _ORIGIN + r"([^?#]*)", 2)
    tail = F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done))
            .when(part == ".", done)
            .otherwise(F.concat(done, F.array(part)))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    closing = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(origin, F.array_join(kept, "/"), closing, tail)


def url_absolute(url: Column, base: Column | str) -> Column:
    """Resolve a link against a base address."""
    base = F.lit(base) if isinstance(base, str) else base
    origin = F.regexp_extract(base, _ORIGIN, 1)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(bare == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(bare, r"[^/]*$", ""))
    joined = (
        F.when(url.rlike(_SCHEME), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), url))
        .when(url.startswith("/"), F.concat(origin, url))
        .when(url == "", base)
        .when(url.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), url))
        .when(url.startswith("?"), F.concat(bare, url))
        .otherwise(F.concat(folder, url))
    )
    dotted = url.rlike(r"(^|/)\.\.?(/|$|[?#])") & ~url.rlike(_SCHEME)
    return F.when(dotted, _without_dots(joined)).otherwise(joined)


def strip_extension(path: Column) -> Column:
    """Drop the last extension of the last path part; names such as ".profile" stay."""
    return F.regexp_replace(path, r"([^./])\.[^./]+$", "$1")


def index_page_url(full_text_url: Column) -> Column:
    return F.concat(strip_extension(full_text_url), F.lit("-index.html"))


def file_extension(path: Column) -> Column:
    """Extension in lower case, empty when there is none."""
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def base_name(path: Column) -> Column:
    """Last path part without its extension."""
    return strip_extension(F.regexp_extract(path, r"([^/]*)$", 1))


def unwrap_viewer(url: Column) -> Column:
    """Point an inline-viewer address at the document it shows."""
    return F.replace(F.replace(url, F.lit("/ix?doc=/"), F.lit("/")), F.lit("ix?doc="), F.lit(""))


def is_viewer_url(url: Column) -> Column:
    return url.contains("ix?doc=")


def form_label(form_type: Column) -> Column:
    """Form type as a path part: no dashes, no slashes."""
    return F.regexp_replace(form_type, "[-/]", "")


def type_label(doc_type: Column) -> Column:
    """Document type as a path part: no spaces, no slashes."""
    return F.translate(doc_type, " /", "")


def content_class(path: Column) -> Column:
    """How a file is fetched: "text" or "raw". The extension is compared as written."""
    ext = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    return F.when(ext.isin(TEXT_EXTENSIONS), F.lit("text")).otherwise(F.lit("raw"))


def path_of(*parts: Column | str) -> Column:
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])
