"""Cosine nearest neighbours of a table of query vectors.

Vectors are unit length, so cosine is a dot product. Documents never move: the
queries (their size checked) are sent to every executor, each Arrow batch of
documents is scored as one matrix product, every task keeps a running top-k per
query, and only those rows are shuffled for the final ranking.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.config import MAX_BROADCAST_BYTES, SCORE_DECIMALS
from rankforge.operators.batch import QueryBatch, prepare_queries
from rankforge.operators.filters import hard_condition
from rankforge.operators.lexical import top_k
from rankforge.storage import materialize


def _matrix(lists: pa.Array) -> np.ndarray:
    """An Arrow list column of equally long vectors as a float64 matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


# Scores computed at a time by one task: 32 MB.
BLOCK_SCORES = 1 << 22


def rank_cells(queries: np.ndarray, centres: np.ndarray, first: int | None = None) -> np.ndarray:
    """Cell numbers per query, nearest first, all or the ``first`` ones; ties go
    to the lower number."""
    sims = np.round(queries @ centres.T * 10.0 ** SCORE_DECIMALS).astype(np.int64)
    n = sims.shape[1]
    keys = -sims * n + np.arange(n)  # all different
    if first is None or first >= n:
        return np.argsort(keys, axis=1)
    near = np.argpartition(keys, first - 1, axis=1)[:, :first]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(keys, near, 1), axis=1), 1)


def _with_cells(queries: DataFrame, centres: np.ndarray, nprobe_col: str) -> DataFrame:
    """``(query_id, embedding, cells)``: the nearest cells of every query, as
    many as ``nprobe_col`` says, worked out in blocks where the queries lie."""
    names = ["query_id", "embedding"]
    schema = T.StructType([*(queries.schema[c] for c in names), T.StructField("cells", T.ArrayType(T.IntegerType()))])
    shared = queries.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, BLOCK_SCORES // len(shared.value))
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                wanted = np.minimum(part.column(2).to_numpy().astype(np.int64), len(shared.value))
                ranking = rank_cells(_matrix(part.column(1)), shared.value, max(1, int(wanted.max())))
                inside = np.arange(ranking.shape[1])[None, :] < wanted[:, None]
                cells = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(wanted))), pa.int32()), pa.array(ranking[inside], pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), cells], names=[*names, "cells"])

    return queries.select(*names, nprobe_col).mapInArrow(run, schema)


class _BestK:
    """The k best (score, id) pairs seen so far, ties by id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, None, None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.scores is not None:
            if len(self.scores) == self.k:
                better = scores >= self.scores[-1]
                if not better.any():
                    return
                scores, ids = scores[better], ids[better]
            scores = np.concatenate([self.scores, scores])
            ids = np.concatenate([self.ids, ids])
        if len(scores) > self.k:
            # all that tie with the k-th best stay, for the id to decide
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= kth
            scores, ids = scores[near], ids[near]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def _search(vectors: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """One pass over the documents for queries that fit the broadcast bound:
    ``asked`` has query_id and embedding, and cells where only those are to be
    looked into."""
    spark = vectors.sparkSession
    id_type, query_type = vectors.schema["doc_id"], asked.schema["query_id"]
    table = asked.where("embedding is not null").toArrow()
    schema = T.StructType([
        T.StructField("query_id", query_type.dataType),
        T.StructField("doc_id", id_type.dataType),
        T.StructField("score", T.DoubleType()),
    ])
    if table.num_rows == 0:
        return spark.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "doc_id", "score")
    q = _matrix(table.column("embedding").combine_chunks())
    probes = None
    if "cells" in table.column_names:
        cells = table.column("cells").combine_chunks()
        number, starts = cells.flatten().to_numpy(), cells.offsets.to_numpy()
        rows = np.repeat(np.arange(len(cells)), np.diff(starts))
        order = np.lexsort((rows, number))
        number, rows = number[order], rows[order]
        visited, first = np.unique(number, return_index=True)
        # cell -> numbers of the queries that look into it
        probes = {int(c): r for c, r in zip(visited, np.split(rows, first[1:]))}
        vectors = vectors.where(F.col("cell").isin(list(probes)))
    query_kind = table.schema.field("query_id").type
    shared = spark.sparkContext.broadcast((q, table.column("query_id").to_pylist(), probes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, query_ids, by_cell = shared.value
        best = [_BestK(k) for _ in query_ids]
        floors = np.full(len(query_ids), -np.inf)  # the k-th scores so far
        doc_kind = None
        for batch in batches:
            doc_kind = batch.schema.field("doc_id").type
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            docs = _matrix(batch.column("embedding"))
            if by_cell is None:
                blocks = [(range(len(query_ids)), slice(None))]
            else:
                cells = batch.column("cell").to_numpy()
                blocks = [(by_cell[c], cells == c) for c in np.unique(cells).tolist()]
            for rows, chosen in blocks:
                rows = np.asarray(rows)
                if not len(rows):
                    continue
                own, own_ids = docs[chosen], ids[chosen]
                if not len(own):
                    continue
                # a block of scores has a fixed size, however many the queries
                step = max(1, BLOCK_SCORES // max(len(own), 1))
                for low in range(0, len(rows), step):
                    part = rows[low:low + step]
                    scores = matrix[part] @ own.T
                    # most queries have k better ones after a few batches
                    near = np.flatnonzero(~(scores.max(axis=1) < floors[part] - 10.0 ** -SCORE_DECIMALS))
                    for i, r in zip(near, part[near]):
                        best[r].add(np.round(scores[i], SCORE_DECIMALS), own_ids)
                        if len(best[r].ids) == k:
                            floors[r] = best[r].scores[-1]
        def rows_of(numbers: list[int]) -> pa.RecordBatch:
            asked = [query_ids[r] for r in numbers for _ in best[r].ids]
            found = np.concatenate([best[r].ids for r in numbers])
            scores = np.concatenate([best[r].scores for r in numbers])
            return pa.RecordBatch.from_arrays(
                [pa.array(asked, query_kind), pa.array(found.tolist(), doc_kind), pa.array(scores)],
                schema.names,
            )

        filled = [r for r, b in enumerate(best) if b.ids is not None and len(b.ids)]
        step = max(1, 10_000 // k)
        for i in range(0, len(filled), step):
            yield rows_of(filled[i:i + step])

    scan = vectors.where("embedding is not null").select(
        "doc_id", "embedding", *(["cell"] if probes is not None else [])
    )
    ranked = top_k(scan.mapInArrow(run, schema), k)
    return ranked.select("query_id", "rank", "doc_id", "score")


def _row_bytes(vectors: DataFrame) -> int:
    first = vectors.select(F.size("embedding")).where("embedding is not null").first()
    return 8 * (first[0] if first else 1)


def _nearest(vectors: DataFrame, queries: DataFrame | QueryBatch, k: int,
             centres: np.ndarray | None, nprobe_col: str | None, max_bytes: int, nprobe: int = 0) -> DataFrame:
    row_bytes = _row_bytes(vectors) + 4 * nprobe

    def run(part: QueryBatch) -> DataFrame:
        if centres is None:
            return _search(vectors, part.queries.select("query_id", "embedding"), k)
        return _search(vectors, _with_cells(part.queries.where("embedding is not null"), centres, nprobe_col), k)

    return prepare_queries(queries).chunks(lambda part: part.n_queries * row_bytes, max_bytes, run)


def exact_knn(vectors: DataFrame, queries: DataFrame | QueryBatch, k: int = 100, *,
              must: Mapping[str, Any] | None = None, geo: Mapping[str, Any] | None = None,
              max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(query_id, rank, doc_id, score)`` by scoring every document.

    Filters apply to the documents before scoring, so a query still gets k
    results whenever k documents pass.
    """
    condition = hard_condition(vectors.schema, must, geo)
    docs = vectors if condition is None else vectors.where(condition)
    return _nearest(docs, queries, k, None, None, max_bytes)


def check_centres(centres: DataFrame) -> None:
    """Raise if the centres are more than a broadcast may hold."""
    size = centres.agg(F.coalesce(F.sum(8 * F.size("embedding")), F.lit(0))).first()[0]
    if size > MAX_BROADCAST_BYTES:
        raise ValueError(f"{size} bytes of cell centres are too many to broadcast")


def train_cells(vectors: DataFrame, n_cells: int, seed: int = 11, max_iter: int = 10) -> np.ndarray:
    """Unit-length k-means centres: the only part of the index that the driver
    holds, ``n_cells x dim`` numbers."""
    if n_cells * 8 * (vectors.select(F.size("embedding")).first()[0]) > MAX_BROADCAST_BYTES:
        raise ValueError("too many cells to broadcast their centres")
    # a zero vector (a text without tokens) has no direction to learn from
    features = vectors.where(F.exists("embedding", lambda x: x != 0)).select(
        array_to_vector("embedding").alias("features")
    )
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(features)
    centres = np.array(model.clusterCenters(), dtype=np.float64)
    norms = np.linalg.norm(centres, axis=1, keepdims=True)
    return np.divide(centres, norms, out=np.zeros_like(centres), where=norms > 0)


def assign_cells(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every vector with the number of its nearest centre, in ``cell``."""
    names = vectors.columns
    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType())])
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("embedding"))
            step = max(1, BLOCK_SCORES // max(len(shared.value), 1))
            parts = [np.round(m[low:low + step] @ shared.value.T, SCORE_DECIMALS).argmax(axis=1)
                     for low in range(0, len(m), step)]
            cells = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(cells.astype(np.int32))],
                [*names, "cell"],
            )

    return vectors.where("embedding is not null").mapInArrow(run, schema)


def cell_knn(vectors: DataFrame, queries: DataFrame | QueryBatch, centres: np.ndarray,
             k: int = 100, nprobe: int = 8, *, must: Mapping[str, Any] | None = None,
             geo: Mapping[str, Any] | None = None,
             max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Approximate search: each query scores only the documents of its
    ``nprobe`` nearest cells, exactly. ``nprobe`` is the recall knob; at the
    number of cells the result is the exact one. Stored partitioned by cell,
    cells no query looks into are not read."""
    if nprobe < 1:
        raise ValueError("nprobe must be at least 1")
    condition = hard_condition(vectors.schema, must, geo)
    docs = vectors if condition is None else vectors.where(condition)
    batch = prepare_queries(queries)
    tagged = QueryBatch(
        batch.queries.withColumn("_nprobe", F.lit(nprobe)), batch.n_queries, batch.n_tokens
    )
    return _nearest(docs, tagged, k, centres, "_nprobe", max_bytes, min(nprobe, len(centres)))


@dataclass(frozen=True)
class CellBounds:
    """Per cell how many vectors it holds, the largest angle of one to the
    centre, the smallest and largest length, and whether one has none."""

    centres: np.ndarray
    rows: np.ndarray
    angle: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray
    zero: np.ndarray

    def limits(self, queries: np.ndarray) -> np.ndarray:
        """Per query and cell a number that no score of the cell's vectors exceeds."""
        size = np.linalg.norm(queries, axis=1, keepdims=True)
        cosine = np.divide(queries @ self.centres.T, size, out=np.zeros((len(queries), len(self.centres))), where=size > 0)
        to_centre = np.arccos(np.clip(cosine, -1.0, 1.0))
        best = np.cos(np.maximum(0.0, to_centre - self.angle - _ANGLE_ROOM))
        limit = np.where(best > 0, best * self.longest, best * self.shortest) * size
        limit = np.where(self.zero, np.maximum(limit, 0.0), limit)
        return np.where(self.rows > 0, limit + _SCORE_ROOM, -np.inf)


# Room for the rounding of angles near 0 and of scores.
_ANGLE_ROOM, _SCORE_ROOM = 1e-6, 1e-6
CELL_STATS = "cell int, n bigint, angle double, shortest double, longest double, zero boolean"


def cell_stats(assigned: DataFrame, centres: np.ndarray) -> DataFrame:
    """One row for each cell of ``assigned`` that holds vectors; see :class:`CellBounds`."""
    shared = assigned.sparkSession.sparkContext.broadcast(centres)
    names = [c.split()[0] for c in CELL_STATS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, cell = _matrix(batch.column(1)), batch.column(0).to_numpy()
            if not len(cell):
                continue
            centre, size = shared.value[cell], np.linalg.norm(m, axis=1)
            around = np.linalg.norm(centre, axis=1) * size
            cosine = np.divide((m * centre).sum(axis=1), around, out=np.full(len(m), -1.0), where=around > 0)
            angle = np.where(size > 0, np.arccos(np.clip(cosine, -1.0, 1.0)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(np.ones(len(cell), np.int64)), pa.array(angle), pa.array(size),
                 pa.array(size), pa.array(size == 0)], names=names)

    rows = assigned.select("cell", "embedding").mapInArrow(run, CELL_STATS)
    return rows.groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("angle").alias("angle"), F.min("shortest").alias("shortest"),
        F.max("longest").alias("longest"), F.max("zero").alias("zero"))


def cell_bounds(stats: DataFrame, centres: np.ndarray) -> CellBounds:
    """The stats of all cells, as few rows as there are centres, beside these."""
    found = {name: np.zeros(len(centres), kind) for name, kind in (
        ("n", np.int64), ("angle", float), ("shortest", float), ("longest", float), ("zero", bool))}
    for r in stats.collect():
        for name, column in found.items():
            column[r["cell"]] = r[name]
    return CellBounds(centres, found["n"], found["angle"], found["shortest"], found["longest"], found["zero"])


@dataclass(frozen=True)
class BoundedResult:
    """``hits``: (query_id, rank, doc_id, score). ``visits``: per query how many
    cells were looked into, of how many, and how many vectors these hold."""

    hits: DataFrame
    visits: DataFrame


def _next_cells(state: DataFrame, bounds: CellBounds, k: int, step: int) -> DataFrame:
    """``(query_id, embedding, done, seen, cells)``: what every query visits now.
    Cells come by their limit, highest first; ``done`` have been visited,
    holding ``seen`` vectors. Without a ``floor``, the k-th score, they must
    hold k vectors; with one, those below it are never visited."""
    shared = state.sparkSession.sparkContext.broadcast(bounds)
    names = ["query_id", "embedding", "done", "seen", "cells"]
    schema = T.StructType([*(state.schema[c] for c in names[:4]), T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            block = max(1, BLOCK_SCORES // len(known.rows))
            for low in range(0, batch.num_rows, block):
                part = batch.slice(low, block)
                limits = known.limits(_matrix(part.column(1)))
                order = np.argsort(-limits, axis=1, kind="stable")
                done, seen = (part.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                floor = part.column(4).to_numpy(zero_copy_only=False).astype(float)
                chosen = []
                for i, places in enumerate(order):
                    ahead = places[done[i]:]
                    if np.isnan(floor[i]):
                        held = seen[i] + np.cumsum(known.rows[ahead])
                        ahead = ahead[:max(step, int(np.searchsorted(held, k)) + 1)]
                    else:
                        ahead = ahead[:step]
                        ahead = ahead[limits[i, ahead] >= floor[i]]
                    chosen.append(ahead[np.isfinite(limits[i, ahead])])
                counts = np.array([len(c) for c in chosen])
                flat = np.concatenate(chosen)
                cells = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(flat, pa.int32()))
                held = np.array([known.rows[c].sum() for c in chosen], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(done + counts), pa.array(seen + held), cells], names=names)

    return state.select(*names[:4], "floor").mapInArrow(run, schema)


def bounded_knn(vectors: DataFrame, queries: DataFrame | QueryBatch, bounds: CellBounds, k: int = 100, *,
                first: int = 2, must: Mapping[str, Any] | None = None, geo: Mapping[str, Any] | None = None,
                max_bytes: int = MAX_BROADCAST_BYTES) -> BoundedResult:
    """The rows of :func:`exact_knn` from as few cells as their bounds allow.

    No vector of a cell is nearer to a query than the cell's largest angle
    lets it be. Queries visit cells by that limit, ``first`` ones, then twice as
    many each round, and stop at the first limit below their k-th score. Each
    round is one scan of the cells that any query still visits.
    """
    condition = hard_condition(vectors.schema, must, geo)
    docs = vectors if condition is None else vectors.where(condition)
    row_bytes, n_cells, spark = _row_bytes(vectors), len(bounds.rows), vectors.sparkSession
    visits: list[DataFrame] = []

    def run(part: QueryBatch) -> DataFrame:
        state = part.queries.where("embedding is not null").select(
            "query_id", "embedding", F.lit(0).cast("bigint").alias("done"), F.lit(0).cast("bigint").alias("seen"),
            F.lit(None).cast("double").alias("floor"))
        best, step = None, first
        while True:
            # cells named at once are bounded like the vectors
            step = max(1, min(step, n_cells, max_bytes // (4 * max(part.n_queries, 1))))
            planned = materialize(_next_cells(state, bounds, k, step), "visits")
            open_ = planned.where(F.size("cells") > 0)
            if best is not None and open_.isEmpty():
                visits.append(planned.select("query_id", "done", "seen"))
                return best
            found = _search(docs, open_.select("query_id", "embedding", "cells"), k).drop("rank")
            if best is not None:
                found = found.unionByName(best.drop("rank"))
            best = materialize(top_k(found, k).select("query_id", "rank", "doc_id", "score"), "nearest")
            floors = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
            # queries that are finished keep their counts
            state = planned.drop("cells").join(floors, "query_id", "left")
            step *= 2

    hits = prepare_queries(queries).chunks(lambda part: part.n_queries * row_bytes, max_bytes, run)
    counted = reduce(DataFrame.unionByName, visits) if visits else spark.createDataFrame([], "query_id int, done bigint, seen bigint")
    return BoundedResult(hits, counted.select(
        "query_id", F.col("done").cast("int").alias("cells"), F.lit(n_cells).alias("of_cells"), F.col("seen").alias("vectors")))


def cell_knn_sweep(vectors: DataFrame, queries: DataFrame, centres: np.ndarray, k: int,
                   settings: list[int], max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(nprobe, query_id, rank, doc_id, score)`` for several settings in one
    pass over the documents: a setting is one more copy of the query."""
    variants = queries.select(
        F.explode(F.array(*map(F.lit, settings))).alias("_nprobe"), "query_id", "embedding"
    )
    keyed = variants.select(
        F.to_json(F.struct("_nprobe", "query_id")).alias("query_id"), "embedding", "_nprobe"
    )
    kind = queries.schema["query_id"].dataType.simpleString()
    found = _nearest(vectors, keyed, k, centres, "_nprobe", max_bytes, min(max(settings), len(centres)))
    key = F.from_json("query_id", f"_nprobe int, query_id {kind}")
    return found.withColumn("_key", key).select(
        F.col("_key._nprobe").alias("nprobe"), F.col("_key.query_id").alias("query_id"),
        "rank", "doc_id", "score",
    )


def filter_shortfall(before: DataFrame, after: DataFrame, queries: DataFrame) -> DataFrame:
    """Results per query when the filter runs inside the search (``before``)
    and when it runs on the finished top-k (``after``)."""
    counted = (
        before.select("query_id", F.lit(1).alias("pre"), F.lit(0).alias("post"))
        .unionByName(after.select("query_id", F.lit(0).alias("pre"), F.lit(1).alias("post")))
        .unionByName(queries.select("query_id", F.lit(0).alias("pre"), F.lit(0).alias("post")))
    )
    return counted.groupBy("query_id").agg(
        F.sum("pre").alias("n_prefilter"), F.sum("post").alias("n_postfilter"),
        (F.sum("pre") - F.sum("post")).alias("shortfall"),
    )
