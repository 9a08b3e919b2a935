"""Line dedup by a join on deletion neighbourhoods, in DataFrame functions only.

Strings within one edit share a variant: the string itself or the string less one character. Emitting every variant of
every line would multiply the corpus by its line length, so lines are narrowed twice. Within one edit, the first or the
last half of two lines is the same, hence a line whose halves occur in no other line has no near copy. The rest, the
crowded lines, are cut around each of ``SEGMENTS`` stretches, in one of which the edit must be; where another line has the
same surroundings, the variants of the stretch are emitted as (surroundings, place of the deletion, hash):

* two lines with the same surroundings, place and hash differ by a substitution, so the earliest line of such a group
  is a neighbour of all others and no pairs inside the group are needed;
* a stretch less one character that equals another whole stretch differs by an insertion.

Every link that comes of it is verified by its edit distance on the whole lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import ROW, staged, with_row_keys
from quarterdeck.operators.stages import compute_once

MIN_CHARS = 20
SEGMENTS = 16
_FILTER_WORDS = 1 << 17  # 64 bits each, that tell which lines may be crowded
BLANKS = " \t\r\x0b\x0c"
_WIDE = "decimal(38,0)"


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def _place(doc_id: Column, line_no: Column) -> Column:
    """One number that orders lines by (doc_id, line_no), null doc_ids last; numbers keep aggregation hashed."""
    doc = (F.coalesce(doc_id.cast("decimal(20,0)"), _number(2**63)) + _number(2**63)).cast("decimal(20,0)")
    return (doc * F.lit(2**32).cast("decimal(11,0)") + line_no.cast("decimal(11,0)")).cast(_WIDE)


def _doc(place: Column) -> Column:
    doc = F.floor(place / F.lit(2**32).cast("decimal(11,0)")).cast(_WIDE) - _number(2**63)
    return F.when(doc < _number(2**63), doc.cast("long"))


def _line_no(place: Column) -> Column:
    return (place % F.lit(2**32).cast("decimal(11,0)")).cast("int")


def lines_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` of all lines that aren't blank, without the blanks around them."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line"))
    return lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''")


def _half_keys() -> Column:
    """Hashes of the first and last half, for a partner as long or longer and for one that is shorter."""
    n = F.char_length("line")

    def keys(half: Column) -> list[Column]:
        first = F.xxhash64(F.lit(0), half, F.substring(F.col("line"), F.lit(1), half))
        last = F.xxhash64(F.lit(1), half, F.substring(F.col("line"), n - half + 1, half))
        return [first, last]

    own, shorter = keys((n / 2).cast("int")), keys(((n - 1) / 2).cast("int"))
    return F.when(n >= MIN_CHARS, F.when(n % 2 == 1, F.array(*own)).otherwise(F.array(*own, *shorter)))


def _crowded(lines: DataFrame) -> DataFrame:
    """``short``, the hash of each line that shares a half with another line."""
    halves = lines.select("short", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("short").alias("low"), F.max("short").alias("high")).where("low <> high").select("half")
    return halves.join(shared, "half").select("short").distinct()


def _crowded_lines(docs: DataFrame, crowded: DataFrame) -> DataFrame:
    """``(first, line, line_key)`` of the lines in ``crowded(short)``, one row each.

    A table of ``_FILTER_WORDS`` rows at most, whatever the corpus, keeps most other lines from being shuffled with their
    texts; the join decides. It is an inner join on distinct keys, since Spark would push a semi join below the filter.
    """
    word, bit = F.pmod(F.shiftright("short", 6), F.lit(_FILTER_WORDS)).alias("word"), F.expr("shiftleft(1L, cast(short & 63 AS int))")
    words = crowded.groupBy(word).agg(F.bit_or(bit).alias("bits"))
    lines = lines_of(docs).withColumn("short", F.xxhash64("line")).withColumn("word", word)
    maybe = lines.join(F.broadcast(words), "word").where(F.col("bits").bitwiseAND(bit) != 0)
    own = maybe.join(crowded, "short").groupBy("line").agg(F.min(_place(F.col("doc_id"), F.col("line_no"))).alias("first"))
    return own.select("first", "line", F.unhex(F.md5("line")).alias("line_key"))


def _segments() -> Column:
    """For each place an edit may be in: a hash of the line around it, and the characters there.

    With ``n`` the length of the shorter line of a pair, the places are ``SEGMENTS`` stretches of n characters; in
    the longer line the stretch has one more. A line takes part as the shorter and as the longer one.
    """
    n = F.char_length("line")

    def pieces(shorter: Column) -> Column:
        def piece(j: Column) -> Column:
            before = F.floor(j * shorter / SEGMENTS).cast("int")
            behind = shorter - F.floor((j + 1) * shorter / SEGMENTS).cast("int")
            around = F.xxhash64(shorter, j, F.substring(F.col("line"), F.lit(1), before), F.substring(F.col("line"), n - behind + 1, behind))
            return F.struct(around.alias("around"), F.substring(F.col("line"), before + 1, n - before - behind).alias("inside"))

        return F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), piece)

    return F.concat(pieces(n), pieces(n - 1))


def _links(crowded: DataFrame) -> DataFrame:
    """Verified ``(line_key, earlier)``: a line, and the place of an earlier line within one edit of it."""
    pieces = crowded.select("first", F.explode(_segments()).alias("s")).select("first", "s.around", "s.inside")
    shared = pieces.groupBy("around").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low <> high")
    close = staged(pieces.join(shared.select("around"), "around"), "close-lines")

    # The deletion neighbourhood of the stretch: itself (at 0), and itself less the character at each place.
    inside, n = F.col("inside"), F.char_length("inside")
    less = F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda at: F.struct(at.alias("at"), F.xxhash64(F.concat(F.substring(inside, F.lit(1), at - 1), F.substring(inside, at + 1, n))).alias("hash")),
    )
    whole = F.struct(F.lit(0).alias("at"), F.xxhash64(inside).alias("hash"))
    variants = close.select("first", "around", F.explode(F.concat(F.array(whole), less)).alias("v")).select("first", "around", "v.at", "v.hash")
    variants = staged(variants, "line-variants")
    lowest = variants.where("at > 0").groupBy("around", "at", "hash").agg(F.min("first").alias("other"))
    swapped = variants.join(lowest, ["around", "at", "hash"]).where("other < first").select("first", "other")
    grown = variants.where("at > 0").select("first", "around", "hash").join(
        variants.where("at = 0").select(F.col("first").alias("other"), "around", "hash"), ["around", "hash"]
    )
    pairs = swapped.unionByName(grown.where("first <> other").select("first", "other"))
    pairs = pairs.select(F.greatest("first", "other").alias("first"), F.least("first", "other").alias("earlier")).distinct()

    later = crowded.select("first", "line_key", "line")
    before = crowded.select(F.col("first").alias("earlier"), F.col("line").alias("earlier_line"))
    checked = pairs.join(later, "first").join(before, "earlier").where(F.levenshtein("line", "earlier_line", 1) >= 0)
    return checked.groupBy("line_key").agg(F.min("earlier").alias("earlier"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per line of ``docs(doc_id, text)`` that isn't blank: doc_id, line_no, keep_doc_id, keep_line_no, kept.

    Lines are the pieces between newlines, numbered from 0, compared without the blanks around them. A line goes if an
    earlier one (by doc_id, then line_no) equals it, or, from ``MIN_CHARS`` characters on in both, is one inserted,
    deleted or replaced character away. keep_* name the earliest of these lines, or the line itself.

    Null and empty texts have no lines; lines of any length take part whole. Rows without doc_id come last; rows
    that repeat a doc_id share their places, so that equal lines in them are one. Other columns are not read.
    """
    rows = lines_of(docs).select("doc_id", "line_no", F.unhex(F.md5("line")).alias("line_key"), F.xxhash64("line").alias("short"), _half_keys().alias("halves"))
    rows = rows.withColumn("place", _place(F.col("doc_id"), F.col("line_no")))
    # Hashes depend on the line alone, so any one of a group serves.
    parts = [F.min(F.get("halves", F.lit(k))).alias(f"h{k}") for k in range(4)]
    packed = rows.groupBy("line_key").agg(F.min("place").alias("first"), F.min("short").alias("short"), *parts)
    halves = F.filter(F.array(*[f"h{k}" for k in range(4)]), lambda h: h.isNotNull())
    distinct = staged(packed.select("line_key", "first", "short", halves.alias("halves")), "lines")

    hot = staged(_crowded(distinct), "crowded")
    crowded = staged(_crowded_lines(docs, hot), "crowded-lines")
    near = staged(_links(crowded), "near-lines")
    keep = distinct.select("line_key", "first").join(near, "line_key", "left")
    keep = staged(keep.select("line_key", F.least("first", "earlier").alias("keep")), "kept-lines")
    named = rows.select("doc_id", "line_no", "line_key", "place").join(keep, "line_key")
    return named.select(
        "doc_id", "line_no", _doc(F.col("keep")).alias("keep_doc_id"), _line_no(F.col("keep")).alias("keep_line_no"), (F.col("keep") == F.col("place")).alias("kept")
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that go; n_chars, if there, follows the new text.

    Documents stay, in the worst case with an empty text; untouched texts stay as they are, a null one too. Rows that share or lack
    a doc_id are told apart (``with_row_keys``), so each loses its own lines only; an empty table gives an empty one.
    """
    keyed = with_row_keys(docs)
    found = line_dedup(keyed.select(F.col(ROW).alias("doc_id"), "text")).where("not kept")
    gone = found.groupBy(F.col("doc_id").alias(ROW)).agg(F.collect_set("line_no").alias("__gone"))
    out = compute_once(keyed.join(gone, ROW, "left"), __pieces=F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("__pieces") - 1), "__gone")
    text = F.array_join(F.transform(left, lambda at: F.get("__pieces", at)), "\n")
    out = out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(changed))
    return out.select(*docs.columns)
