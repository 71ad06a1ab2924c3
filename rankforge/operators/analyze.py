"""Comparisons of runs and sweeps of settings.

A setting is a column, not a loop: retrieval happens once and every setting is
scored from the same ranked lists in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.fusion import fuse
from rankforge.operators.metrics import evaluate_queries, mean_metrics
from rankforge.operators.rerank import head_and_tail


def query_sample(queries: DataFrame, n: int, seed: int = 11) -> DataFrame:
    """``n`` queries in an order drawn from the seed: the same ones each time,
    wherever the rows lie."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("query_id").cast("string")))
    return queries.orderBy(key, "query_id").limit(n)


def relative_to_baseline(means: DataFrame, baseline: str, metric: str = "ndcg_10") -> DataFrame:
    """Change of a metric against the baseline variant, in per cent."""
    base = means.where(F.col("variant") == baseline).select(metric).scalar()
    change = F.when(F.col("_base") > 0, (F.col(metric) / F.col("_base") - 1) * 100)
    return means.withColumn("_base", base).select("variant", F.round(change, 1).alias("pct_vs_baseline"))


def recall_ceiling(means: DataFrame, metric: str = "recall_100") -> DataFrame:
    """The best recall of any variant, and the share no reranker can reach."""
    best = F.max(metric)
    return means.agg(best.alias("ceiling"), (1 - best).alias("never_retrieved"))


def weight_sweep(lists: DataFrame, qrels: DataFrame, run_queries: DataFrame,
                 weights: Sequence[tuple[float, float]] = ((1, 0), (2, 1), (1, 1), (1, 2), (0, 1)),
                 rrf_k: int = 60) -> DataFrame:
    """Mean NDCG@10 for several weightings of the same two ranked lists."""
    settings = F.array(*(
        F.struct(F.lit(f"{a:g}:{b:g}").alias("weights"), F.lit(float(a)).alias("w0"),
                 F.lit(float(b)).alias("w1"))
        for a, b in weights
    ))
    each = lists.withColumn("_s", F.explode(settings)).select(
        "_s.*", "query_id", "list_idx", "rank", "doc_id"
    )
    weight = F.when(F.col("list_idx") == 0, F.col("w0")).otherwise(F.col("w1"))
    run = fuse(each, 2, k=rrf_k, weight=weight, by=["weights"])
    asked = run_queries.select(F.explode(settings).alias("_s"), "query_id").select("_s.weights", "query_id")
    per_query = evaluate_queries(run, qrels, ks=(10,), recall_ks=(), by=["weights"], run_queries=asked)
    return mean_metrics(per_query, ["weights"])


def depth_sweep(ranked: DataFrame, scores: DataFrame, qrels: DataFrame, run_queries: DataFrame,
                depths: Sequence[int] = (5, 10, 25, 50)) -> DataFrame:
    """Mean NDCG@10 when the first ``depth`` results are reranked. ``scores``
    holds the pair scores down to the largest depth, computed once."""
    settings = F.explode(F.array(*map(F.lit, depths))).alias("depth")
    each = ranked.select(settings, "query_id", "rank", "doc_id")
    run = head_and_tail(each, scores, "depth", by=["depth"])
    asked = run_queries.select(settings, "query_id")
    per_query = evaluate_queries(run, qrels, ks=(10,), recall_ks=(), by=["depth"], run_queries=asked)
    return mean_metrics(per_query, ["depth"])


def recall_sweep(approximate: DataFrame, exact: DataFrame, k: int = 10,
                 by: str = "nprobe") -> DataFrame:
    """Share of the exact top k that each setting of an approximate search found."""
    truth = exact.where(F.col("rank") <= k).select("query_id", "doc_id")
    total = truth.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = (
        approximate.where(F.col("rank") <= k).select(by, "query_id", "doc_id")
        .join(truth, ["query_id", "doc_id"], "left_semi")
        .groupBy(by).agg(F.count(F.lit(1)).alias("_found"))
    )
    settings = approximate.select(by).distinct()
    return settings.join(found, by, "left").withColumn("_total", total).select(
        by, (F.coalesce("_found", F.lit(0)) / F.col("_total")).alias(f"recall_{k}")
    )


def side_by_side(left: DataFrame, right: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Two ranked lists of each query, row by row; null where one is shorter."""
    both = left.select("query_id", "rank", F.lit(0).alias("_list"), "doc_id").unionByName(
        right.select("query_id", "rank", F.lit(1).alias("_list"), "doc_id")
    )
    shown = ["doc_id"]
    if docs is not None:
        both = both.join(docs.select("doc_id", "title"), "doc_id", "left")
        shown.append("title")
    return both.groupBy("query_id", "rank").agg(*(
        F.max(F.when(F.col("_list") == i, F.col(c))).alias(f"{side}_{c}")
        for c in shown for i, side in enumerate(("left", "right"))
    ))


def rank_shift(before: DataFrame, after: DataFrame, top: int = 10) -> DataFrame:
    """The first ``top`` of one ranking with their place in another."""
    old = before.select("query_id", "doc_id", F.col("rank").alias("rank_before"))
    new = after.where(F.col("rank") <= top).select(
        "query_id", "doc_id", F.col("rank").alias("rank_after")
    )
    return new.join(old, ["query_id", "doc_id"], "left").withColumn(
        "moved", F.col("rank_before") - F.col("rank_after")
    )


def disagreement(left: DataFrame, right: DataFrame, k: int = 10) -> DataFrame:
    """Overlap and Jaccard index of two top-k lists, per query."""
    both = left.where(F.col("rank") <= k).select(
        "query_id", "doc_id", F.lit(1).alias("l"), F.lit(0).alias("r")
    ).unionByName(right.where(F.col("rank") <= k).select(
        "query_id", "doc_id", F.lit(0).alias("l"), F.lit(1).alias("r")
    ))
    per_doc = both.groupBy("query_id", "doc_id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    common = F.sum(F.col("l") * F.col("r"))
    return per_doc.groupBy("query_id").agg(
        F.sum("l").alias("n_left"), F.sum("r").alias("n_right"), common.alias("n_common"),
        (common / F.count(F.lit(1))).alias("jaccard"),
    )


def expected_winner(modes: Mapping[str, DataFrame], probes: DataFrame) -> DataFrame:
    """Which mode ranks a probe's target best.

    ``probes`` has query_id, doc_id (the target) and expected, a mode. The result
    has a row for each probe with ``rank_<mode>`` (null: not found), ``winner``,
    the mode with the smallest rank, the first named one of several, null if none
    found it, and ``as_expected``.
    """
    found = probes
    for name, ranked in modes.items():
        places = ranked.groupBy("query_id", "doc_id").agg(F.min("rank").alias(f"rank_{name}"))
        found = found.join(places, ["query_id", "doc_id"], "left")
    best = F.array_min(F.array(*(
        F.when(F.col(f"rank_{name}").isNotNull(), F.struct(
            F.col(f"rank_{name}").cast("bigint").alias("rank"), F.lit(i).alias("place"), F.lit(name).alias("mode")))
        for i, name in enumerate(modes))))
    return found.withColumn("winner", best["mode"]).withColumn(
        "as_expected", F.col("winner").eqNullSafe(F.col("expected")))


def coverage_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many (query, document) pairs reranking lost or gained: both are 0,
    since it only reorders what retrieval found."""
    both = before.select("query_id", "doc_id", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select("query_id", "doc_id", F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    per_pair = both.groupBy("query_id", "doc_id").agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return per_pair.groupBy("query_id").agg(
        F.sum("b").alias("n_before"), F.sum("a").alias("n_after"),
        F.sum(F.col("b") * (1 - F.col("a"))).alias("n_lost"),
        F.sum(F.col("a") * (1 - F.col("b"))).alias("n_gained"),
    )
