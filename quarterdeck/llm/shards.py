"""Sharding by a minimax contiguous partition.

Equal texts are one atomic group; groups are ordered by their digest. The smallest capacity with which the
ordered groups fit into the shards is searched by halving, each try filling the shards greedily, and the order is cut
there. The groups themselves stay distributed: the driver sees sums over digest prefixes, at first 4096 of them,
and asks for longer prefixes only around the cuts. A capacity is bounded from above by filling shards with whole
prefixes, and from below by letting cuts fall anywhere inside a prefix of several groups. Once both bounds meet,
the capacity is the smallest one and the cuts are known.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import staged
from quarterdeck.operators.ordered import number_rows

ROW_BYTES = 16
_FIRST_DIGITS, _MORE_DIGITS = 3, 2
_SLOT_BUCKETS = 1024


class Span(NamedTuple):
    """The groups whose digests begin with ``prefix``: their bytes and their number."""

    prefix: str
    size: int
    groups: int


def _smallest(low: int, high: int, fits: Callable[[int], bool]) -> int:
    """The smallest value that fits, of which ``high`` is known to."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return high


def _fill(spans: list[Span], capacity: int, loose: bool) -> list[int]:
    """Ends of the shards (in bytes from the start) when each takes as much as it can.

    Strict filling takes whole spans only; where a span is larger than the capacity, it takes that span alone.
    Loose filling may also end inside a span of several groups, and so never ends before the exact filling.
    """
    ends, start, at = [], 0, 0
    for span in spans:
        at += span.size
        while at - start > capacity:
            before = at - span.size
            if loose and span.groups > 1:
                end = start + capacity
            elif before > start:
                end = before
            else:
                break  # a span larger than the capacity
            ends.append(end)
            start = end
    return [*ends, at]


def _bounds(spans: list[Span], shards: int) -> tuple[int, int]:
    total = sum(s.size for s in spans)
    atoms = max((s.size for s in spans if s.groups == 1), default=0)
    least = max(-(-total // shards), atoms)
    high = _smallest(max(least, max(s.size for s in spans)), total, lambda c: len(_fill(spans, c, False)) <= shards)
    low = _smallest(least, high, lambda c: len(_fill(spans, c, True)) <= shards)
    return low, high


def _around_cuts(spans: list[Span], low: int, high: int) -> list[str]:
    """Prefixes of several groups in which a cut of the exact answer may lie."""
    firsts, lasts = _fill(spans, low, False), _fill(spans, high, True)
    windows = list(zip(firsts, lasts))
    found, at, k = [], 0, 0
    for span in spans:
        start, at = at, at + span.size
        while k < len(windows) and windows[k][1] < start:
            k += 1
        # Windows overlap, so look at all that begin before this span ends.
        if span.groups > 1 and any(a <= at and start <= b for a, b in windows[k:]):
            found.append(span.prefix)
    return found


def cut_points(groups: DataFrame, shards: int) -> list[str]:
    """First prefixes of the second to last shard, for ``groups(digest, size)``."""

    def spans_of(rows: DataFrame, digits: int) -> list[Span]:
        sums = rows.groupBy(F.substring("digest", 1, digits).alias("prefix")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"))
        return [Span(*r) for r in sums.collect()]

    spans = sorted(spans_of(groups, _FIRST_DIGITS))
    if not spans:
        return []
    low, high = _bounds(spans, shards)
    while low < high:
        by_length: dict[int, list[str]] = {}
        for prefix in _around_cuts(spans, low, high):
            by_length.setdefault(len(prefix), []).append(prefix)
        split = {p for ps in by_length.values() for p in ps}
        finer = [s for n, ps in by_length.items() for s in spans_of(groups.where(F.substring("digest", 1, n).isin(ps)), n + _MORE_DIGITS)]
        spans = sorted([s for s in spans if s.prefix not in split] + finer)
        low, high = _bounds(spans, shards)
    return _even_cuts(spans, shards, high)


def _even_cuts(spans: list[Span], shards: int, capacity: int) -> list[str]:
    """Of the cuts that keep to the capacity, those nearest to equal shards.

    Filling from the left alone would leave the last shard with what happens to be over. Cut k may lie anywhere
    from where filling from the right begins to the capacity above the cut before it.
    """
    edges = [0, *accumulate(s.size for s in spans)]
    total = edges[-1]
    earliest = [total]
    for _ in range(shards - 1):
        earliest.append(edges[bisect_left(edges, earliest[-1] - capacity)])
    earliest.reverse()
    cuts, last = [], 0
    for k in range(1, shards):
        low = bisect_left(edges, max(earliest[k - 1], edges[last]))
        high = bisect_right(edges, edges[last] + capacity) - 1
        near = bisect_left(edges, k * total // shards)
        last = min(max(near, low), high)
        if last < len(spans):
            cuts.append(spans[last].prefix)
    return cuts


def minimax_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, size, text_crc32, shard, slot.

    Size is the UTF-8 bytes of the text plus ``ROW_BYTES``. Equal texts share a shard; the largest shard is as small
    as any contiguous cut of the ordered groups allows. Slots number a shard's rows from 0 without gaps.

    Null texts are one group of no bytes, apart from the empty texts, with checksum 0. Rows may repeat or lack a
    doc_id; each gets a slot of its own. With fewer groups than shards the last shards stay empty. Other columns
    are not read; an empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    rows = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.sha2(F.coalesce(F.concat(F.lit("t"), text), F.lit("")), 256).alias("digest"),
        ),
        "shard-rows",
    )
    groups = staged(rows.groupBy("digest").agg(F.sum("size").alias("size")), "shard-groups")
    cuts = cut_points(groups, shards)
    shard: Column = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("digest") >= cut).cast("int")
    placed = rows.withColumn("shard", shard).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(_SLOT_BUCKETS)))
    # Buckets of a hash: a group of copies spreads over all of them, and slots need no order.
    numbered = number_rows(placed, ["shard"], [F.col("doc_id"), F.col("digest")], F.col("bucket"), "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).cast("long").alias("slot"))
