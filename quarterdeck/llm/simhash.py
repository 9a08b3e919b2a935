"""SimHash near-dedup with pigeonhole blocks.

A fingerprint is cut into six blocks. Two that differ in three bits or fewer agree on at least three blocks, so
they share one of the twenty keys made of three blocks. Fingerprints, not documents, are joined on these keys:
copies of a text are one row, however many there are. Each joined pair is verified by its Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import ROW, staged, with_row_keys
from quarterdeck.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
_WIDTHS = (11, 11, 11, 11, 10, 10)
_SLICE = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 if it has no words."""
    # On bytes, split() knows just the white space of the contract and lower() just A-Z.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [words]
    else:
        shingles = zip(*(words[k:] for k in range(SHINGLE_WORDS)))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _SLICE):
        part = hashes[start : start + _SLICE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes)], names=["doc_id", "code"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, code)``, the fingerprint as signed long, of every row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_fingerprints, "doc_id long, code long")


def _masks() -> list[int]:
    """The bits of each of the twenty keys, as signed longs."""
    starts = np.cumsum((0, *_WIDTHS[:-1]))
    blocks = [((1 << w) - 1) << int(s) for s, w in zip(starts, _WIDTHS)]
    unsigned = [sum(c) for c in combinations(blocks, len(blocks) - MAX_BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in unsigned]


def close_pairs(codes: DataFrame) -> DataFrame:
    """``(a, b)`` with a < b for all pairs of ``codes(code)``, distinct ones, that differ in few bits."""
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("code").bitwiseAND(F.lit(m)).alias("block")) for k, m in enumerate(_masks())]))
    keyed = codes.select(F.col("code"), keys.alias("key")).select("code", "key.k", "key.block")
    left, right = keyed.withColumnRenamed("code", "a"), keyed.withColumnRenamed("code", "b")
    pairs = left.join(right, ["k", "block"]).where(F.col("a") < F.col("b"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b").distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, fingerprint (hex), component_id (its smallest doc_id).

    Null and empty texts and texts of white space have fingerprint zero and are linked like any other. A null
    doc_id never names a component unless all its rows lack one (component_id null). Repeated rows give
    repeated rows; other columns are not read; an empty table gives an empty result.
    """
    rows = staged(fingerprints(docs), "fingerprints")
    codes = staged(rows.groupBy("code").agg(F.min("doc_id").alias("first_id")), "codes")
    roots = components(close_pairs(codes.select("code")))
    rooted = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Staged, so that the last join is a plain one whose hot partitions Spark can split.
    named = staged(rooted.join(least, "root").select("code", "component_id"), "components")
    return rows.join(named, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The first document of each component, by doc_id, with all columns of ``docs``.

    Rows that share or lack a doc_id are told apart and come last (``with_row_keys``): each stays or goes by its own text. Null and empty
    texts are one component; an empty table gives an empty one.
    """
    keyed = with_row_keys(docs)
    found = simhash_components(keyed.select(F.col(ROW).alias("doc_id"), "text"))
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias(ROW))
    return keyed.join(dropped, ROW, "left_anti").select(*docs.columns)
