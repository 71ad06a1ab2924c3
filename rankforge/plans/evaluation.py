"""The four-variant comparison: retrieve once, score every variant in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.batch import QueryBatch, prepare_queries
from rankforge.operators.encode import encode_queries
from rankforge.operators.fusion import fuse, hybrid_lists
from rankforge.operators.knn import cell_knn_sweep, exact_knn
from rankforge.operators.metrics import evaluate_queries, mean_metrics
from rankforge.operators.rerank import PairScorer, head_and_tail, score_pairs
from rankforge.storage import materialize

VARIANTS = ("lexical", "neural", "hybrid", "hybrid + rerank")


@dataclass(frozen=True)
class Runs:
    """What the variants are made of: the two ranked lists per query, their
    fusion, and the pair scores of the fused head. All are small (queries x k
    rows) and written once."""

    batch: QueryBatch
    lists: DataFrame
    fused: DataFrame
    scores: DataFrame
    rerank_depth: int

    def list(self, i: int) -> DataFrame:
        return self.lists.where(F.col("list_idx") == i)

    def reranked(self, depth: int | None = None) -> DataFrame:
        return head_and_tail(self.fused, self.scores, depth or self.rerank_depth)

    def variants(self) -> DataFrame:
        """``(variant, query_id, rank, doc_id)`` of all four."""
        parts = (self.list(0), self.list(1), self.fused, self.reranked())
        return reduce(DataFrame.unionByName, (
            df.select(F.lit(name).alias("variant"), "query_id", "rank", "doc_id")
            for name, df in zip(VARIANTS, parts, strict=True)
        ))

    def asked(self) -> DataFrame:
        """Every (variant, query) pair, with or without results."""
        return self.batch.queries.select(
            F.explode(F.array(*map(F.lit, VARIANTS))).alias("variant"), "query_id"
        )


def collect_runs(index, queries: DataFrame | QueryBatch, k: int = 100, rerank_depth: int = 25,
                 rrf_k: int = 60, scorer: PairScorer | None = None, score_depth: int | None = None,
                 **options) -> Runs:
    batch = prepare_queries(queries)
    lists = materialize(hybrid_lists(index, batch, k, **options), "lists")
    fused = materialize(fuse(lists, 2, k=rrf_k), "fused")
    depth = max(rerank_depth, score_depth or 0)
    scores = materialize(score_pairs(fused, batch, index, scorer, depth), "scores")
    return Runs(batch, lists, fused, scores, rerank_depth)


def per_query_metrics(runs: Runs, qrels: DataFrame, **options) -> DataFrame:
    return evaluate_queries(
        runs.variants(), qrels, by=["variant"], run_queries=runs.asked(), **options
    )


def variant_comparison(runs: Runs, qrels: DataFrame, **options) -> DataFrame:
    return mean_metrics(per_query_metrics(runs, qrels, **options), ["variant"])


def index_recall(index, queries: DataFrame | QueryBatch, k: int, settings: Sequence[int]) -> DataFrame:
    """``(nprobe, recall, worst)``: the share of the exact k nearest documents
    that an index's stored cells give, on average and for the worst query. All
    settings share one scan. A query table of some hundreds tells enough."""
    batch = prepare_queries(queries)
    asked = materialize(encode_queries(batch.queries, index.check_encoder(None)).select("query_id", "embedding"), "asked")
    truth = materialize(exact_knn(index.vectors, asked, k).select("query_id", "doc_id"), "truth")
    swept = cell_knn_sweep(index.vectors, asked, index.centres, k, list(settings))
    found = swept.join(truth, ["query_id", "doc_id"], "left_semi").groupBy("nprobe", "query_id").agg(
        F.count(F.lit(1)).alias("found"))
    wanted = truth.groupBy("query_id").agg(F.count(F.lit(1)).alias("wanted")).select(
        F.explode(F.array(*map(F.lit, settings))).alias("nprobe"), "query_id", "wanted")
    share = F.coalesce("found", F.lit(0)) / F.col("wanted")
    return wanted.join(found, ["nprobe", "query_id"], "left").groupBy("nprobe").agg(
        F.avg(share).alias("recall"), F.min(share).alias("worst"))


def smallest_nprobe(index, queries: DataFrame | QueryBatch, k: int, target: float = 0.95,
                    settings: Sequence[int] | None = None) -> int:
    """The smallest of ``settings`` (by default doublings) with at least the
    ``target`` recall; all cells, if none has it."""
    n = len(index.centres)
    settings = sorted(settings or {min(2 ** i, n) for i in range(n.bit_length() + 1)})
    measured = {r["nprobe"]: r["recall"] for r in index_recall(index, queries, k, settings).collect()}
    return next((s for s in settings if measured.get(s, 0.0) >= target), n)
