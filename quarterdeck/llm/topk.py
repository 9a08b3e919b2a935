"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of similar length. A query's k-th best score so far, divided by its
own length and a bucket's largest, is the cosine a vector of that bucket needs at least. Above 1, the whole bucket is
passed over. If the threshold is low, candidates are those whose length alone can reach the score; if it is high, those
whose coordinate in the query's strongest direction lies in the range that the cosine allows. Candidates are verified
by whole integer products. All bounds are widened by a margin for rounding, so no result is lost.

The first pass lets each query see the bucket of the longest vectors only, which gives a score to prune with. The
second joins blocks of queries with the buckets that any of them may still need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import staged

SCALE = 256
QUERY_EVERY = 50
BUCKET_ROWS = 4096
BLOCK_ROWS = 256
HIGH_COSINE = 0.5  # from this local threshold on, coordinates prune better than lengths
_MARGIN = 1e-9
_EXACT = float(2**53)


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, vector array<double>, norm)`` with whole numbers as components.

    Rows without vec_id or vector and vectors with a null, infinite or NaN component take no part.
    """
    values = F.col("embedding").cast("array<double>")
    whole = F.transform(values, lambda x: F.floor(x * F.lit(float(SCALE))).cast("double"))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v"), whole.alias("vector"), bad.alias("bad"))
    good = good.where("vec_id is not null and v is not null and not bad").select("vec_id", "vector")
    return good.withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))


_BLOB = pa.schema([("number", pa.int64()), ("rows", pa.int64()), ("width", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()), ("data", pa.binary())])
_BLOB_SQL = "number long, rows long, width long, longest double, ids binary, data binary"


def _blobs(rows_each: int):
    """Rows, in the order they come, as matrices of at most ``rows_each``; shorter vectors are padded with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, ids, vectors, longest = TaskContext.get().partitionId(), 0, [], [], 0.0

        def blob() -> pa.RecordBatch:
            width = max(map(len, vectors))
            grid = np.zeros((len(vectors), width))
            for k, v in enumerate(vectors):
                grid[k, : len(v)] = v
            row = [task << 32 | number, len(ids), width, longest, np.array(ids, dtype=np.int64).tobytes(), grid.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOB.types)], schema=_BLOB)

        for batch in batches:
            lists = batch.column(1)
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for vec_id, a, b, norm in zip(batch.column(0).to_pylist(), bounds, bounds[1:], batch.column(2).to_pylist()):
                ids.append(vec_id)
                vectors.append(flat[a:b])
                longest = max(longest, norm)
                if len(ids) == rows_each:
                    yield blob()
                    number, ids, vectors, longest = number + 1, [], [], 0.0
        if ids:
            yield blob()

    return run


class _Bucket:
    """A bucket's vectors, their directions, and the order of its rows along each coordinate used so far."""

    def __init__(self, ids: bytes, data: bytes, width: int):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.grid = np.frombuffer(data, dtype=np.float64).reshape(len(self.ids), width)
        self.norms = np.linalg.norm(self.grid, axis=1)
        self.by_length = np.argsort(-self.norms, kind="stable")
        self.sorted_lengths = -self.norms[self.by_length]
        self.longest = float(self.norms.max(initial=0.0))
        self.directions = self.grid / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.orders: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def order(self, axis: int) -> tuple[np.ndarray, np.ndarray]:
        if axis not in self.orders:
            rows = np.argsort(self.directions[:, axis], kind="stable")
            self.orders[axis] = rows, self.directions[rows, axis]
        return self.orders[axis]

    def candidates(self, query: np.ndarray, norm: float, least: float) -> np.ndarray:
        """Rows whose product with the query may reach ``least``."""
        reach = norm * self.longest * (1 + _MARGIN) + _MARGIN
        if least > reach:
            return np.zeros(0, dtype=np.int64)
        if least <= 0 or norm == 0:
            return np.arange(len(self.ids))
        cosine = min(least / reach, 1.0)
        if cosine < HIGH_COSINE:
            long_enough = np.searchsorted(self.sorted_lengths, -least / norm * (1 - _MARGIN) + _MARGIN, side="right")
            return self.by_length[:long_enough]
        width = min(len(query), self.grid.shape[1])
        axis = int(np.abs(query[:width]).argmax())
        # Directions within arccos(cosine) of the query: their angle to the axis differs by no more than that.
        angle, spread = np.arccos(np.clip(query[axis] / norm, -1, 1)), np.arccos(cosine) + 1e-7
        low, high = np.cos(min(np.pi, angle + spread)) - 1e-9, np.cos(max(0.0, angle - spread)) + 1e-9
        rows, values = self.order(axis)
        found = rows[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
        return found[self.norms[found] * norm * (1 + _MARGIN) + _MARGIN >= least]

    def products(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integer products, in doubles where these are exact and in whole numbers of any size where not."""
        width = min(len(query), self.grid.shape[1])
        part, own = self.grid[rows, :width], query[:width]
        if np.abs(own).max(initial=0) * np.abs(part).max(initial=0) * width < _EXACT:
            return (part @ own).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(row, own)) for row in part]
        return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], dtype=np.int64)


def _best(bucket: _Bucket, query_id: int, query: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best ids and scores of a bucket that reach ``least``; ties go to the smaller id."""
    rows = bucket.candidates(query, float(np.linalg.norm(query)), least)
    rows = rows[bucket.ids[rows] != query_id]
    ids, scores = bucket.ids[rows], bucket.products(query, rows)
    if len(ids) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _search(k: int):
    """Joined (query block, bucket) rows to the best of each query in that bucket."""
    names = ["block", "query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                block, q_ids, q_data, q_width, floors, ids, data, width = (c[row].as_py() for c in batch.columns)
                bucket = _Bucket(ids, data, width)
                query_ids = np.frombuffer(q_ids, dtype=np.int64)
                grid = np.frombuffer(q_data, dtype=np.float64).reshape(len(query_ids), q_width)
                known = {f["query_id"]: f["floor"] for f in floors or []}
                found = [_best(bucket, i, query, known.get(i, -np.inf), k) for i, query in zip(query_ids.tolist(), grid)]
                ids, scores = (np.concatenate([f[n] for f in found]) for n in range(2))
                columns = [np.full(len(ids), block), np.repeat(query_ids, [len(f[0]) for f in found]), ids, scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


_HITS = "block long, query_id long, vec_id long, score long"
_PAIR = ["block", "q_ids", "q_data", "q_width", "floors", "ids", "data", "width"]
_LEVELS = 4  # steps of length for each doubling


def _level(length: Column) -> Column:
    return F.floor(F.log2(F.greatest(length, F.lit(1.0))) * _LEVELS).cast("int")


def _needed(blocks: DataFrame, buckets: DataFrame, longest: float) -> DataFrame:
    """``(block, number)``: the buckets of which a block ``(block, q_longest, lowest)`` may need a vector.

    An equi-join on steps of length, from the least a block needs to the longest there is.
    """
    least = F.when(F.col("q_longest") > 0, F.col("lowest") / F.col("q_longest")).when(F.col("lowest") <= 0, 0.0)
    asking = blocks.withColumn("needs", F.greatest(least, F.lit(0.0)) * (1 - 2 * _MARGIN)).where("needs is not null")
    top = _level(F.lit(longest * (1 + _MARGIN)))
    asking = asking.where(_level(F.col("needs")) <= top).select("block", "needs", F.explode(F.sequence(_level(F.col("needs")), top)).alias("level"))
    offered = buckets.select("number", "longest", _level(F.col("longest")).alias("level"))
    return asking.join(offered, "level").where("longest >= needs").select("block", "number")


def top_products(embeddings: DataFrame, k: int = 5, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest integer inner products of each query.

    Components are floor(256 x). Queries are the rows of ``embeddings(vec_id, embedding)`` whose vec_id is divisible by
    ``QUERY_EVERY``; candidates are all rows with another vec_id; ties go to the smaller vec_id.

    See ``integer_vectors`` for rows that take no part. Vectors of other lengths are padded with zeros, so an empty one
    scores 0 with all. Rows that repeat a vec_id are candidates each; of a repeated query one row, any, is asked.
    A score beyond a long is the nearest long. Other columns are not read; empty tables give empty results.
    """
    vectors = staged(integer_vectors(embeddings), "vectors")
    # Length first; vec_id spreads vectors of one length over partitions.
    order = [F.col("norm").desc(), F.col("vec_id")]
    buckets = staged(vectors.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blobs(bucket_rows), _BLOB_SQL), "buckets")
    asked = vectors.where(F.col("vec_id") % QUERY_EVERY == 0).dropDuplicates(["vec_id"])
    asked = asked.repartition(max(1, -(-asked.count() // block_rows)))
    top = buckets.orderBy(F.col("longest").desc(), "number").select("number", "longest").first()
    first_number, longest = (top.number, top.longest) if top else (-1, 0.0)
    # Each block names the bucket it asks first as a stored value, so that the join stays one on equal keys.
    blocks = staged(asked.mapInArrow(_blobs(block_rows), _BLOB_SQL).withColumn("seed", F.lit(first_number)), "query-blocks")
    queries = blocks.select(F.col("number").alias("block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("width").alias("q_width"), F.col("longest").alias("q_longest"))

    # First pass: the bucket of the longest vectors, which shows what score a query has at least.
    asking = blocks.select(F.col("number").alias("block"), F.col("seed").alias("number"))
    seeds = queries.join(asking, "block").join(buckets.select("number", "ids", "data", "width"), "number")
    first = staged(seeds.withColumn("floors", F.lit(None).cast("array<struct<query_id:long,floor:double>>")).select(*_PAIR).mapInArrow(_search(k), _HITS), "first-hits")
    kth = first.groupBy("block", "query_id").agg(F.count(F.lit(1)).alias("hits"), F.min("score").cast("double").alias("floor"))
    # One array element per query of a block, of which there are block_rows at most.
    kth = kth.withColumn("floor", F.when(F.col("hits") >= k, F.col("floor")).otherwise(float("-inf")))
    floors = kth.groupBy("block").agg(F.collect_list(F.struct("query_id", "floor")).alias("floors"), F.min("floor").alias("lowest"), F.count(F.lit(1)).alias("known"))
    floored = queries.join(floors, "block", "left")
    floored = staged(floored.withColumn("lowest", F.when(F.col("known") == F.octet_length("q_ids") / 8, F.col("lowest")).otherwise(float("-inf"))), "floors")

    # Second pass: lengths alone tell which blocks need which buckets, before any vectors move.
    needs = _needed(floored.select("block", "q_longest", "lowest"), buckets.where(F.col("number") != first_number), longest)
    pairs = needs.join(floored, "block").join(buckets.select("number", "ids", "data", "width"), "number")
    rest = pairs.select(*_PAIR).mapInArrow(_search(k), _HITS)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
