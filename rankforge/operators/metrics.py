"""Offline relevance metrics over whole runs.

A run is ``(*by, query_id, rank, doc_id)``; ``by`` names the columns that tell
several runs in one table apart (variant, weight, depth, ..). Judgments are
``(query_id, doc_id, label)``, one row per pair. Documents nobody judged count
as not relevant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.config import LABEL_GRADES, RELEVANT_LABELS, UNJUDGED
from rankforge.sources.judged import label_value

_SALTS = 64


def _check_cutoffs(ks: Sequence[int | None]) -> None:
    if any(k is not None and k < 1 for k in ks):
        raise ValueError("a cutoff is at least 1, or None for the whole list")


def gain_at(rank: Column, grade: Column) -> Column:
    """What one result adds to DCG: ``(2^grade - 1) / log2(rank + 1)``."""
    return (F.pow(F.lit(2.0), grade) - 1) / F.log2(rank + 1)


def _at(k: int | None, rank: Column) -> Column:
    return F.lit(True) if k is None else rank <= k


def _suffix(k: int | None) -> str:
    return "all" if k is None else str(k)


def dcg(graded: DataFrame, ks: Sequence[int | None] = (None,), by: Sequence[str] = ()) -> DataFrame:
    """``(*by, query_id, dcg_k ..)`` of ``(*by, query_id, rank, grade)`` rows."""
    _check_cutoffs(ks)
    gain = gain_at(F.col("rank"), F.col("grade"))
    return graded.groupBy(*by, "query_id").agg(
        *(
            F.sum(F.when(_at(k, F.col("rank")), gain).otherwise(0.0)).alias(f"dcg_{_suffix(k)}")
            for k in ks
        )
    )


def graded_judgments(qrels: DataFrame, grades: Mapping[str, float] | None = None,
                     relevant: Sequence[str] | None = None, gain_col: str | None = None) -> DataFrame:
    """``(query_id, doc_id, grade, relevant)``. ``gain_col`` takes the grade
    from a numeric column of the judgments instead of their label."""
    for name, value in (("grades", grades), ("relevant", relevant)):
        if value is not None and not value:
            raise ValueError(f"{name} must not be empty; leave it out for the default")
    grade = F.col(gain_col) if gain_col else label_value(F.col("label"), grades or LABEL_GRADES)
    return qrels.select(
        "query_id", "doc_id", grade.cast("double").alias("grade"),
        F.col("label").isin(list(relevant or RELEVANT_LABELS)).alias("relevant"),
    )


def ideal_positions(judged: DataFrame, depth: int | None) -> DataFrame:
    """``(query_id, grade, rank)``: the judgments in their best order.

    With a depth, every partition hands on at most that many rows per query.
    Without one, all rows are numbered: per grade and salt first, then shifted
    by the sizes of the groups before, so that a query with very many
    judgments is never sorted in one task.
    """
    if depth is not None:
        w = Window.partitionBy("query_id").orderBy(F.desc("grade"))
        return (
            judged.select("query_id", "grade", F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= depth)
        )
    salted = judged.select(
        "query_id", "grade", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).alias("_salt"), "doc_id"
    )
    before = (
        Window.partitionBy("query_id").orderBy(F.desc("grade"), "_salt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        salted.groupBy("query_id", "grade", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    within = Window.partitionBy("query_id", "grade", "_salt").orderBy("doc_id")
    return (
        salted.withColumn("_place", F.row_number().over(within))
        .join(shifts, ["query_id", "grade", "_salt"])
        .select("query_id", "grade", (F.col("_place") + F.col("_shift")).alias("rank"))
    )


def _deepest(ks: Sequence[int | None]) -> int | None:
    return None if any(k is None for k in ks) else max(ks, default=1)


def evaluate_queries(run: DataFrame, qrels: DataFrame, *, ks: Sequence[int | None] = (5, 10),
                     recall_ks: Sequence[int | None] = (10, 100), by: Sequence[str] = (),
                     grades: Mapping[str, float] | None = None,
                     relevant: Sequence[str] | None = None, gain_col: str | None = None,
                     run_queries: DataFrame | None = None) -> DataFrame:
    """``(*by, query_id, ndcg_k .., recall_k ..)`` for every judged query of the
    run.

    ``run_queries`` (*by, query_id) names the queries that were asked, so that
    one without results still scores 0; by default those with results. A query
    without judgments is left out; one without a relevant document scores 0.
    """
    _check_cutoffs([*ks, *recall_ks])
    by = list(by)
    judged = graded_judgments(qrels, grades, relevant, gain_col)
    depth = _deepest([*ks, *recall_ks])
    seen = run if depth is None else run.where(F.col("rank") <= depth)
    hits = seen.select(*by, "query_id", "rank", "doc_id").join(judged, ["query_id", "doc_id"], "left")
    gain = gain_at(F.col("rank"), F.coalesce("grade", F.lit(0.0)))
    found = F.coalesce("relevant", F.lit(False))
    per_run = hits.groupBy(*by, "query_id").agg(
        *(
            F.sum(F.when(_at(k, F.col("rank")), gain).otherwise(0.0)).alias(f"_dcg_{_suffix(k)}")
            for k in ks
        ),
        *(
            F.count_if(found & _at(k, F.col("rank"))).alias(f"_hits_{_suffix(k)}") for k in recall_ks
        ),
    )
    if run_queries is not None:
        per_run = run_queries.select(*by, "query_id").distinct().join(per_run, [*by, "query_id"], "left")

    n_relevant = judged.groupBy("query_id").agg(F.count_if("relevant").alias("_relevant"))
    joined = per_run.join(n_relevant, "query_id")
    if ks:
        best = gain_at(F.col("rank"), F.col("grade"))
        ideal = ideal_positions(judged, _deepest(ks)).groupBy("query_id").agg(
            *(
                F.sum(F.when(_at(k, F.col("rank")), best).otherwise(0.0)).alias(f"_ideal_{_suffix(k)}")
                for k in ks
            )
        )
        joined = joined.join(ideal, "query_id")

    def ratio(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.coalesce(part, F.lit(0)) / F.col(whole)).otherwise(0.0)

    return joined.select(
        *by, "query_id",
        *(ratio(f"_dcg_{_suffix(k)}", f"_ideal_{_suffix(k)}").alias(f"ndcg_{_suffix(k)}") for k in ks),
        *(ratio(f"_hits_{_suffix(k)}", "_relevant").alias(f"recall_{_suffix(k)}") for k in recall_ks),
    )


def mean_metrics(per_query: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every metric averaged over the queries; no queries give no rows."""
    names = [c for c in per_query.columns if c.startswith(("ndcg_", "recall_"))]
    means = [F.avg(c).alias(c) for c in names]
    out = per_query.groupBy(*by).agg(F.count(F.lit(1)).alias("n_queries"), *means)
    return out.where(F.col("n_queries") > 0)


def evaluate_run(run: DataFrame, qrels: DataFrame, *, by: Sequence[str] = (), **options) -> DataFrame:
    return mean_metrics(evaluate_queries(run, qrels, by=by, **options), by)


def judged_ranking(ranked: DataFrame, qrels: DataFrame) -> DataFrame:
    """Results next to their labels; those nobody judged are marked."""
    labels = qrels.select("query_id", "doc_id", "label")
    return ranked.join(labels, ["query_id", "doc_id"], "left").withColumn(
        "label", F.coalesce("label", F.lit(UNJUDGED))
    )
