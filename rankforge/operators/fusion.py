"""Reciprocal rank fusion of several ranked lists per query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.batch import QueryBatch, prepare_queries
from rankforge.operators.encode import encode_queries
from rankforge.operators.filters import hard_condition
from rankforge.operators.knn import bounded_knn, cell_knn, exact_knn
from rankforge.operators.lexical import lexical_search

_DECIMALS = 12


def as_lists(*ranked: DataFrame) -> DataFrame:
    """Number ranked lists 0, 1, ... and stack them:
    ``(query_id, list_idx, rank, doc_id, score)``."""
    return reduce(
        DataFrame.unionByName,
        (
            df.select("query_id", F.lit(i).alias("list_idx"), "rank", "doc_id", "score")
            for i, df in enumerate(ranked)
        ),
    )


def _weight(weights: Sequence[float] | None, n_lists: int) -> Column:
    if weights is None:
        return F.lit(1.0)
    if len(weights) != n_lists:
        raise ValueError(f"{len(weights)} weights for {n_lists} lists")
    table = F.create_map(*(F.lit(x) for i, w in enumerate(weights) for x in (i, float(w))))
    return table[F.col("list_idx")]


def fuse(lists: DataFrame, n_lists: int, *, k: int = 60, weights: Sequence[float] | None = None,
         weight: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, query_id, rank, doc_id, rrf_score, rank_0, rank_1, .., score_0, ..)``.

    A document scores the sum of ``weight / (k + rank)`` over the lists that
    hold it. ``rank_i`` and ``score_i`` say where list i had it (null when it
    did not). Equal scores keep the order of first appearance: lowest list,
    then lowest rank. ``weight`` may be a column, to fuse several settings
    (named by ``by``) in one job.
    """
    w = weight if weight is not None else _weight(weights, n_lists)
    provenance = [
        F.max(F.when(F.col("list_idx") == i, F.col(c))).alias(f"{c}_{i}")
        for c in ("rank", "score") if c in lists.columns
        for i in range(n_lists)
    ]
    fused = lists.groupBy(*by, "query_id", "doc_id").agg(
        F.round(F.sum(w / (k + F.col("rank"))), _DECIMALS).alias("rrf_score"),
        F.min(F.struct("list_idx", F.col("rank").alias("r"))).alias("_first"),
        *provenance,
    )
    order = Window.partitionBy(*by, "query_id").orderBy(F.desc("rrf_score"), F.asc("_first"))
    names = [c for c in fused.columns if c not in (*by, "query_id", "doc_id", "rrf_score", "_first")]
    return fused.select(
        *by, "query_id", F.row_number().over(order).alias("rank"), "doc_id", "rrf_score", *names
    )


def rank_map(n_lists: int) -> Column:
    """``{list_idx: rank}`` of a fused row, without the lists that missed it."""
    pairs = F.create_map(*(x for i in range(n_lists) for x in (F.lit(i), F.col(f"rank_{i}"))))
    return F.map_filter(pairs, lambda _, r: r.isNotNull())


def neural_search(index, queries: DataFrame | QueryBatch, k: int = 100, *, encoder=None,
                  must: Mapping[str, Any] | None = None, geo: Mapping[str, Any] | None = None,
                  should: Mapping[str, Any] | None = None, nprobe: int | str | None = None) -> DataFrame:
    """Nearest documents to the encoded queries: exact, over the ``nprobe``
    nearest cells, or, with ``nprobe="bounded"``, exact from as few cells as
    their bounds allow. Soft preferences do not reach vector search. A filter on a
    field that is not stored with the vectors, such as a searchable text, is
    looked up in the documents."""
    if nprobe is not None and index.centres is None:
        raise ValueError("nprobe needs an index with cells")
    encoder = index.check_encoder(encoder)
    batch = prepare_queries(queries)
    asked = QueryBatch(encode_queries(batch.queries, encoder), batch.n_queries, batch.n_tokens)
    vectors = index.vectors
    if not {*(must or {}), *(["location"] if geo else [])} <= set(vectors.columns):
        eligible = index.docs.where(hard_condition(index.docs.schema, must, geo)).select("doc_id")
        vectors, must, geo = vectors.join(eligible, "doc_id", "left_semi"), None, None
    if nprobe is None:
        return exact_knn(vectors, asked, k, must=must, geo=geo)
    if nprobe == "bounded":
        return bounded_knn(vectors, asked, index.cells, k, must=must, geo=geo).hits
    return cell_knn(vectors, asked, index.centres, k, nprobe, must=must, geo=geo)


def hybrid_lists(index, queries: DataFrame | QueryBatch, k: int = 100, *, encoder=None,
                 must=None, should=None, geo=None, nprobe: int | str | None = None) -> DataFrame:
    """The lexical (0) and the neural (1) list of every query, stacked."""
    batch = prepare_queries(queries)
    return as_lists(
        lexical_search(index, batch, k, must=must, should=should, geo=geo),
        neural_search(index, batch, k, encoder=encoder, must=must, geo=geo, nprobe=nprobe),
    )


def hybrid_search(index, queries: DataFrame | QueryBatch, k: int = 100, *, rrf_k: int = 60,
                  weights: Sequence[float] | None = None, **options) -> DataFrame:
    """Both retrievers with the same k and filters, fused. The union may hold
    more than k documents per query."""
    _weight(weights, 2)
    return fuse(hybrid_lists(index, queries, k, **options), 2, k=rrf_k, weights=weights)
