"""The funnel over a table of queries: retrieve, trim, rerank, final cut."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.config import FunnelParams
from rankforge.operators.batch import QueryBatch, prepare_queries
from rankforge.operators.fusion import hybrid_search, neural_search
from rankforge.operators.lexical import lexical_search
from rankforge.operators.rerank import PairScorer, rerank
from rankforge.storage import materialize


def retrieve(index, queries: DataFrame | QueryBatch, mode: str, k: int, rrf_k: int = 60,
             nprobe: int | str | None = None, **filters) -> DataFrame:
    """Candidates of one mode as ``(query_id, rank, doc_id, score)``."""
    if mode == "lexical":
        return lexical_search(index, queries, k, **filters)
    if mode == "neural":
        return neural_search(index, queries, k, nprobe=nprobe, **filters)
    if mode == "hybrid":
        fused = hybrid_search(index, queries, k, rrf_k=rrf_k, nprobe=nprobe, **filters)
        return fused.select("query_id", "rank", "doc_id", F.col("rrf_score").alias("score"))
    raise ValueError(f"mode must be hybrid, lexical or neural, not {mode!r}")


@dataclass(frozen=True)
class FunnelResult:
    """``documents``: (query_id, rank, doc_id, score, ce_score, retrieval_rank,
    rank_delta), the final rows. ``trace``: one row per query and stage."""

    documents: DataFrame
    trace: DataFrame


def run(index, queries: DataFrame | QueryBatch, mode: str = "hybrid",
        params: FunnelParams = FunnelParams(), *, must: Mapping[str, Any] | None = None,
        should: Mapping[str, Any] | None = None, geo: Mapping[str, Any] | None = None,
        do_rerank: bool = True, scorer: PairScorer | None = None,
        nprobe: int | str | None = None) -> FunnelResult:
    """All stages for all queries; vector search is exact, over ``nprobe``
    cells, or exact through cells with ``nprobe="bounded"``. The candidates, a few rows per query, are written once: ranking,
    scoring and the trace all read them."""
    batch = prepare_queries(queries)
    candidates = materialize(
        retrieve(index, batch, mode, params.candidates, params.rrf_k, nprobe,
                 must=must, should=should, geo=geo),
        "candidates",
    )
    trimmed = candidates.where(F.col("rank") <= params.after_trim)
    if do_rerank:
        depth = min(params.after_trim, params.rerank_top_k)
        third = rerank(trimmed, batch, index, scorer, depth=depth)
        third = third.join(
            candidates.select("query_id", "doc_id", "score"), ["query_id", "doc_id"]
        )
        third = materialize(third, "reranked")
    else:
        depth = params.after_trim
        third = trimmed.select(
            "query_id", "doc_id", "rank", "score",
            F.lit(None).cast("double").alias("ce_score"),
            F.col("rank").alias("retrieval_rank"), F.lit(0).alias("rank_delta"),
        )
    final = third.where(F.col("rank") <= params.final_k).select(
        "query_id", "rank", "doc_id", "score", "ce_score", "retrieval_rank", "rank_delta"
    )
    trace = _trace(batch.queries, candidates, third, mode, params, depth, do_rerank)
    return FunnelResult(final, trace)


def _stage(no: int, name: str, n_in: Column, n_out: Column, top: str) -> Column:
    return F.struct(
        F.lit(no).alias("stage_no"), F.lit(name).alias("stage"),
        n_in.cast("bigint").alias("n_in"), n_out.cast("bigint").alias("n_out"),
        F.coalesce(F.col(top), F.array().cast("array<string>")).alias("top_ids"),
    )


def _first_ids(limit: int, *, reranked: bool) -> Column:
    """The ids at ranks 1..limit of one list of a query, in order."""
    row = F.when(
        (F.col("_reranked") == reranked) & (F.col("rank") <= limit),
        F.struct("rank", F.col("doc_id").cast("string").alias("id")),
    )
    return F.transform(F.array_sort(F.collect_list(row)), lambda r: r["id"])


def _trace(queries: DataFrame, candidates: DataFrame, third: DataFrame, mode: str,
           params: FunnelParams, depth: int, do_rerank: bool) -> DataFrame:
    """``(query_id, stage_no, stage, n_in, n_out, top_ids)`` for every query,
    also one without any candidate. At most three ids are gathered per list."""
    rows = (
        candidates.select("query_id", "rank", "doc_id", F.lit(False).alias("_reranked"))
        .unionByName(third.select("query_id", "rank", "doc_id", F.lit(True).alias("_reranked")))
    )
    first = ~F.col("_reranked")
    per_query = rows.groupBy("query_id").agg(
        F.count_if(first).alias("c"),
        F.count_if(first & (F.col("rank") <= params.after_trim)).alias("t"),
        F.count_if(first & (F.col("rank") <= depth)).alias("s"),
        F.count_if(F.col("_reranked")).alias("r"),
        F.count_if(F.col("_reranked") & (F.col("rank") <= params.final_k)).alias("f"),
        _first_ids(min(3, params.after_trim), reranked=False).alias("t_top"),
        _first_ids(3, reranked=False).alias("c_top"),
        _first_ids(3, reranked=True).alias("r_top"),
        _first_ids(min(3, params.final_k), reranked=True).alias("f_top"),
    )
    filled = queries.select("query_id").join(per_query, "query_id", "left").na.fill(0)
    # fixed values: the names of the stages
    third_name = "3. rerank" if do_rerank else "3. rerank (skipped)"
    stages = F.array(
        _stage(1, f"1. retrieve ({mode})", F.lit(params.candidates), F.col("c"), "c_top"),
        _stage(2, "2. trim", F.col("c"), F.col("t"), "t_top"),
        _stage(3, third_name, F.col("s"), F.col("r"), "r_top"),
        _stage(4, "4. final", F.col("r"), F.col("f"), "f_top"),
    )
    return filled.select("query_id", F.explode(stages).alias("_s")).select("query_id", "_s.*")


def trace_text() -> Column:
    """A trace row as one fixed-width line."""
    # fixed value: the layout of the line
    return F.format_string(
        "%-22s %4d -> %-4d  top: %s", "stage", "n_in", "n_out", F.array_join("top_ids", ", ")
    )
