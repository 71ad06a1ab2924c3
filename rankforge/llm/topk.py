"""Exact top-k by inner product with KD-trees.

Vectors are dealt to shards of bounded size by a hash. A task builds the tree of a
shard once, and the queries stream past it in blocks of bounded size. The tree
splits at medians and keeps the tight bounding box of every node. A query visits
nodes best first, by the largest inner product its box allows, and stops when
that is below its k-th score. Each query searches one shard first; the k-th score
found there is its starting bound in all other shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import table
from rankforge.storage import materialize


@dataclass(frozen=True)
class TopKParams:
    k: int = 20
    shard_rows: int = 16_384
    query_rows: int = 4096  # of a block that is searched at a time
    leaf_rows: int = 256


class KdTree:
    """Median splits along the widest side, down to ``leaf_rows`` rows."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf_rows: int):
        order = np.arange(len(ids))
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[slice] = []
        low, high = [], []

        def grow(begin: int, end: int) -> int:
            own = vectors[order[begin:end]]
            node = len(self.children)
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            self.children.append(None)
            self.rows.append(slice(begin, end))
            sides = high[node] - low[node]
            if end - begin > leaf_rows and sides.size and sides.max() > 0:
                middle = (end - begin) // 2
                part = np.argpartition(own[:, sides.argmax()], middle)
                order[begin:end] = order[begin:end][part]
                self.children[node] = (grow(begin, begin + middle), grow(begin + middle, end))
            return node

        grow(0, len(ids))
        self.vectors, self.ids = vectors[order], ids[order]
        self.low, self.high = np.array(low), np.array(high)

    def as_kind(self, kind) -> KdTree:
        """The same tree over numbers of another type."""
        if self.vectors.dtype != kind:
            self.vectors, self.low, self.high = (a.astype(kind) for a in (self.vectors, self.low, self.high))
        return self

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per query and node the largest inner product that its box allows."""
        zero = queries.dtype.type(0)
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray, own_id: int, k: int, floor: float):
        """(scores, ids) of at most k rows: those that can be among the best k
        and score at least ``floor``."""
        scores, ids = np.zeros(0, self.vectors.dtype), np.zeros(0, np.int64)
        heap = [(-bounds[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if -most < floor:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= floor:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.rows[node]
            value = self.vectors[rows] @ query
            good = np.flatnonzero((value >= floor) & (self.ids[rows] != own_id))
            if not len(good):
                continue
            scores = np.concatenate([scores, value[good]])
            ids = np.concatenate([ids, self.ids[rows][good]])
            if len(scores) >= k:
                best = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[best], ids[best]
                floor = max(floor, scores[-1])
        return scores, ids


@dataclass(frozen=True)
class Shard:
    """A tree over the vectors of one shard, all of one length."""

    tree: KdTree
    largest: int

    @classmethod
    def of(cls, vectors: list[np.ndarray], ids: list[np.ndarray], leaf_rows: int) -> Shard:
        rows = np.concatenate(vectors)
        return cls(KdTree(rows, np.concatenate(ids), leaf_rows), int(np.abs(rows).max(initial=0)))

    def search(self, asked: np.ndarray, own_ids: np.ndarray, floors: np.ndarray, k: int):
        """(number of the query, vec_id, score) of the rows that can be among a query's best k."""
        largest = max(self.largest, int(np.abs(asked).max(initial=0)))
        # products of integers are exact in doubles up to 2 ** 53, and much faster
        kind = np.float64 if largest * largest * max(asked.shape[1], 1) < 1 << 53 else np.int64
        tree = self.tree.as_kind(kind)
        asked = asked.astype(kind)
        lowest = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
        bounds = tree.bounds(asked)
        found = [
            tree.search(asked[i], bounds[i], int(own_ids[i]), k, kind(floors[i]) if np.isfinite(floors[i]) else lowest)
            for i in range(len(asked))]
        return (np.repeat(np.arange(len(asked)), [len(s) for s, _ in found]), np.concatenate([i for _, i in found]),
                np.concatenate([s for s, _ in found]).astype(np.int64))


def whole_numbers(embedding: Column) -> Column:
    """floor(64 * x) of every component."""
    return F.transform(embedding, lambda x: F.floor(F.lit(64.0) * x.cast("double")).cast("bigint"))


def top_k(vectors: DataFrame, is_query: Column, params: TopKParams = TopKParams()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best k rows of each query row by
    the inner product of ``vector`` (whole numbers), ties to the smaller vec_id.

    ``vectors`` has vec_id and vector. A null id, a null vector and one with a
    null component take no part; vectors of another length than the query's are
    no candidates, nor are rows with the query's id. A query row that comes
    twice is answered once, a candidate that comes twice counts twice. No rows
    give none; other columns are not read.
    """
    k, leaf_rows = params.k, params.leaf_rows
    whole = vectors.where("vec_id is not null and vector is not null").where(
        ~F.exists("vector", lambda x: x.isNull()))
    base = materialize(whole.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "vector", is_query.alias("asked"), F.size("vector").alias("dim")),
        "vectors")
    asked = materialize(base.where("asked").select(
        "vec_id", "vector", "dim", F.xxhash64("vec_id", "vector").alias("query")).distinct(), "queries")
    n, m = base.count(), asked.count()
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not n or not m:
        return empty
    shards, query_rows = -(-n // params.shard_rows), params.query_rows
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["shard", "dim", "query", "vec_id", "vector", "floor"]
    rows = base.select(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)).alias("shard"), "dim",
                       F.lit(None).cast("bigint").alias("query"), "vec_id", "vector",
                       F.lit(None).cast("double").alias("floor"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vectors, ids, shard = None, [], [], None
        for batch in batches:
            of = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            asks = ~batch.column(2).is_null().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((of[1:] != of[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            for low, high in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                if tuple(of[low]) != key:
                    key, vectors, ids, shard = tuple(of[low]), [], [], None
                for begin in range(low, high, query_rows):
                    part = batch.slice(begin, min(query_rows, high - begin))
                    matrix = part.column(4).flatten().to_numpy().reshape(part.num_rows, -1)
                    own = part.column(3).to_numpy()
                    if not asks[low]:
                        vectors.append(matrix)
                        ids.append(own)
                        continue
                    if not vectors and shard is None:
                        continue  # queries of a length that the shard does not hold
                    if shard is None:
                        shard, vectors, ids = Shard.of(vectors, ids, leaf_rows), [], []
                    floors = part.column(5).to_numpy(zero_copy_only=False).astype(float)
                    which, found, scores = shard.search(matrix, own, floors, k)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(2).take(pa.array(which)), part.column(3).take(pa.array(which)), pa.array(found),
                         pa.array(scores)], names=["query", "query_id", "vec_id", "score"])

    def search(vectors: DataFrame, queries: DataFrame) -> DataFrame:
        # a shard's vectors come before its queries
        dealt = vectors.unionByName(queries.select(*names)).repartition(tasks, "shard", "dim").sortWithinPartitions(
            "shard", "dim", F.col("query").asc_nulls_first())
        return dealt.mapInArrow(apply, "query bigint, query_id bigint, vec_id bigint, score bigint")

    home = F.pmod("query", F.lit(shards))
    first = materialize(search(
        rows, asked.withColumn("shard", home).withColumn("floor", F.lit(None).cast("double"))), "first")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    found = first
    if shards > 1:
        floors = first.groupBy("query").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("floor"))
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))
        others = asked.join(floors, "query", "left").withColumn("shard", F.explode(every)).where(F.col("shard") != home)
        found = first.unionByName(search(rows, others))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    finite = embeddings.where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return top_k(finite.select("vec_id", whole_numbers(F.col("embedding")).alias("vector")), F.col("vec_id") % 20 == 0)
