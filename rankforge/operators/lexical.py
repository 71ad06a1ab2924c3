"""BM25 over a table of queries.

Postings are partitioned by document, as search shards are. The weighted query
terms are broadcast, so the join with the postings, the sums per (query,
document) and the first top-k all happen inside one partition; only the k best
documents per query and partition are shuffled. A term that occurs in every
document makes no shuffle and no hot task, and when such terms would make too
many pairs, exact bounds leave them out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.config import (
    FIELD_BOOSTS, MAX_BROADCAST_ROWS, MAX_PUSHED_TERMS, MAX_SCORED_PAIRS, MAX_TASK_PAIRS, SCORE_DECIMALS,
    TERM_SPLITS, Bm25Params,
)
from rankforge.operators.batch import QueryBatch, prepare_queries, query_terms
from rankforge.operators.filters import hard_condition, soft_score
from rankforge.storage import materialize

# Bounds are sums in another order than the scores: this much room for rounding.
_MARGIN = 1e-6
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(scored: DataFrame, k: int, *, by: str = "score") -> DataFrame:
    """Rank per query, best first, ties by id. ``row_number() <= k`` lets Spark
    cut every partition to k rows per query before the shuffle; it does so up to
    a k that is a session setting, which is raised here where k is larger."""
    if k < 1:
        raise ValueError("k must be at least 1")
    conf = scored.sparkSession.conf
    if k > int(conf.get(_GROUP_LIMIT)):
        conf.set(_GROUP_LIMIT, str(k))
    w = Window.partitionBy("query_id").orderBy(F.desc(by), F.asc("doc_id"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def idf(n_docs: Column, df: Column) -> Column:
    return F.log1p((n_docs - df + 0.5) / (df + 0.5))


def weighted_terms(terms: DataFrame, term_stats: DataFrame, field_stats: DataFrame,
                   boosts: Mapping[str, float], broadcast: bool = True) -> DataFrame:
    """``(query_id, field, term, weight, avgdl, df)`` for the terms that occur.
    Terms that are not few enough to ``broadcast`` meet their counts by a shuffle."""
    boost = F.create_map(*(F.lit(x) for kv in boosts.items() for x in (kv[0], float(kv[1]))))
    return (
        term_stats.where(F.col("field").isin(list(boosts)))
        .join(F.broadcast(terms) if broadcast else terms, "term")
        .join(F.broadcast(field_stats), "field")  # one row per field
        .select(
            "query_id", "field", "term", "avgdl", "df",
            (boost[F.col("field")] * F.col("qtf") * idf(F.col("n_docs"), F.col("df"))).alias("weight"),
        )
    )


def bm25(postings: DataFrame, weighted: DataFrame, fields: Sequence[str],
         params: Bm25Params = Bm25Params(), keys: Sequence[str] = ("field", "term"),
         broadcast: bool = True) -> DataFrame:
    """``(query_id, doc_id, score)``: the best field's sum over the query terms.

    Terms are OR-ed. ``weighted`` is sent to the postings, or, if it is too
    large to ``broadcast``, both are shuffled by ``keys``. A ``bonus`` column of
    the postings (one value per document) is added.
    """
    length = (1 - params.b) + params.b * F.col("dl") / F.col("avgdl")
    part = F.col("weight") * F.col("tf") / (F.col("tf") + params.k1 * length)
    keep = [c for c in ("bonus",) if c in postings.columns]
    # one sum per field, side by side, saves a second aggregation
    sums = [F.sum(F.when(F.col("field") == f, F.col("part"))) for f in fields]
    total = F.greatest(*sums, F.lit(0.0)) + (F.max("bonus") if keep else 0.0)
    terms = weighted.select(*dict.fromkeys(["query_id", "field", "term", "weight", "avgdl", *keys]))
    return (
        postings.join(F.broadcast(terms) if broadcast else terms, list(keys))
        .select("query_id", "doc_id", "field", part.alias("part"), *keep)
        .groupBy("query_id", "doc_id")
        .agg(F.round(total, SCORE_DECIMALS).alias("score"))
    )


def _full_scores(postings: DataFrame, pairs: DataFrame, weighted: DataFrame, fields: Sequence[str],
                 params: Bm25Params) -> DataFrame:
    """The scores of given (query, document) pairs. The pairs, not the postings,
    move to the documents' partitions, and the postings stream past them."""
    known = postings.join(pairs.select("doc_id", "query_id").hint("shuffle_hash"), "doc_id")
    return bm25(known, weighted, fields, params, keys=("query_id", "field", "term"))


def _floors(postings: DataFrame, weighted: DataFrame, k: int, fields: Sequence[str],
            params: Bm25Params) -> DataFrame:
    """``(query_id, floor)``: a score the k-th best document surely reaches.

    The rarest terms of a query, enough of them to meet several times k
    documents, name some promising documents; the k-th best full score among
    those is a lower bound. Fewer than k such documents make no floor.
    """
    per_term = weighted.groupBy("query_id", "term").agg(F.sum("df").alias("df"))
    before = (
        Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    )
    rare = (
        per_term.withColumn("_met", F.coalesce(F.sum("df").over(before), F.lit(0)))
        .where(F.col("_met") < 8 * k).select("query_id", "term")
    )
    seeds = weighted.join(rare, ["query_id", "term"], "left_semi")
    promising = materialize(top_k(bm25(postings, seeds, fields, params), 2 * k), "promising")
    best = top_k(_full_scores(postings, promising, weighted, fields, params), k)
    return best.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))


def pruned_bm25(postings: DataFrame, weighted: DataFrame, k: int, fields: Sequence[str],
                params: Bm25Params = Bm25Params(), max_bonus: float = 0.0) -> DataFrame:
    """The same k best rows as :func:`bm25`, without pairing every query with
    every document that shares a frequent term (MaxScore, Turtle & Flood 1995).

    A term adds less than its weight to a score. The terms that cannot even
    together lift a document to the floor of the k-th best need not be looked
    up on their own: only documents with one of the other terms are scored, and
    of those only the ones that can still reach the floor in full.
    """
    weighted = materialize(weighted, "terms")
    vocabulary = F.broadcast(weighted.select("field", "term").distinct())
    postings = postings.join(vocabulary, ["field", "term"], "left_semi")
    bounds = weighted.groupBy("query_id", "term").agg(F.max("weight").alias("most"))
    upto = (
        Window.partitionBy("query_id").orderBy("most", "term")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Half the floor, not all of it: the rest must then come from needed terms,
    # which few documents achieve, and the most frequent terms are left out anyway.
    reach = F.coalesce(F.col("floor") / 2, F.lit(0.0))
    optional = (F.col("_sum") + max_bonus + _MARGIN) < reach
    marked = materialize(
        bounds.withColumn("_sum", F.sum("most").over(upto))
        .join(_floors(postings, weighted, k, fields, params), "query_id", "left")
        .select("query_id", "term", "floor", optional.alias("optional"),
                F.when(optional, F.col("_sum")).alias("_sum")),
        "bounds",
    )
    needed = weighted.join(
        F.broadcast(marked.where(~F.col("optional")).select("query_id", "term")),
        ["query_id", "term"], "left_semi",
    )
    limits = marked.groupBy("query_id").agg(
        F.max("floor").alias("floor"), F.coalesce(F.max("_sum"), F.lit(0.0)).alias("rest")
    )
    hopeful = (
        bm25(postings, needed, fields, params)
        .join(F.broadcast(limits), "query_id")
        .where(F.col("floor").isNull() | (F.col("score") + F.col("rest") + _MARGIN >= F.col("floor")))
    )
    return _full_scores(postings, hopeful, weighted, fields, params)


def shuffled_bm25(postings: DataFrame, weighted: DataFrame, fields: Sequence[str],
                  params: Bm25Params = Bm25Params()) -> DataFrame:
    """The rows of :func:`bm25` for any number of queries, from one scan of the
    postings: query terms and postings meet in a shuffle by term.

    A term's pairs are its documents times its queries. Terms with more than a
    ``TERM_SPLITS``-th of all pairs, fewer than that many, are cut by document:
    their postings go to several tasks, and their queries to each of these.
    """
    weighted = materialize(weighted, "terms")
    pairs = weighted.groupBy("field", "term").agg((F.count(F.lit(1)) * F.max("df")).alias("pairs"))
    total = pairs.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    cuts = F.ceil(F.col("pairs") * TERM_SPLITS / F.lit(max(total, 1)))
    hot = materialize(pairs.select("field", "term", cuts.alias("_cuts")).where("_cuts > 1"), "hot-terms")
    parts = F.coalesce("_cuts", F.lit(1))
    cut = postings.join(F.broadcast(hot), ["field", "term"], "left").withColumn(
        "_part", F.pmod(F.xxhash64("doc_id"), parts)).drop("_cuts")
    asked = weighted.join(F.broadcast(hot), ["field", "term"], "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("_cuts")
    return bm25(cut, asked, fields, params, keys=("field", "term", "_part"), broadcast=False)


def _wanted_terms(batch: QueryBatch) -> Column | None:
    """A condition on ``term`` that the scan can use, for few query terms: files
    are sorted by term, so parquet skips the pages without any of them. One
    equality for each term, since a longer ``IN`` becomes a range."""
    if batch.n_tokens > MAX_PUSHED_TERMS:
        return None
    found = [r["term"] for r in query_terms(batch.queries).select("term").distinct().collect()]
    return reduce(lambda a, b: a | b, [F.col("term") == t for t in sorted(found)], F.lit(False)) if found else None


def lexical_search(index, queries: DataFrame | QueryBatch, k: int = 100, *,
                   must: Mapping[str, Any] | None = None,
                   should: Mapping[str, Any] | None = None,
                   geo: Mapping[str, Any] | None = None,
                   boosts: Mapping[str, float] | None = None,
                   params: Bm25Params = Bm25Params(),
                   should_weight: float = 1.0,
                   max_pairs: int = MAX_SCORED_PAIRS,
                   max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                   max_task_pairs: int = MAX_TASK_PAIRS) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the k best documents per query.

    Hard filters restrict the documents; soft ones add ``should_weight`` per
    matched clause to the score of documents that match a query term. Up to
    ``max_pairs`` (query term, document) pairs are all scored; beyond that
    :func:`pruned_bm25` finds the same rows. Queries of more than
    ``max_broadcast_rows`` terms go through :func:`shuffled_bm25`. The other ways
    sum up every bucket's pairs in memory: queries with more than
    ``max_task_pairs`` of these are cut, one pass over the postings for each part.
    """
    boosts = dict(boosts or FIELD_BOOSTS)
    batch = prepare_queries(queries)
    condition = hard_condition(index.docs.schema, must, geo)
    bonus = soft_score(index.docs.schema, should, should_weight)

    def eligible(docs: DataFrame, post: DataFrame) -> DataFrame:
        post = post.where(F.col("field").isin(list(boosts)))
        if condition is None and bonus is None:
            return post
        docs = docs if condition is None else docs.where(condition)
        extra = [] if bonus is None else [bonus.alias("bonus")]
        # both tables are bucketed by document: no shuffle
        return post.join(docs.select("doc_id", *extra), "doc_id", "inner" if extra else "left_semi")

    # a document is live in one segment only
    parts = [eligible(s.docs, s.postings) for s in index.segments] or [eligible(index.docs, index.postings)]
    n_docs = index.field_stats.agg(F.max("n_docs")).first()[0] or 0
    in_bucket = -(-n_docs // (index.buckets or batch.queries.sparkSession.sparkContext.defaultParallelism))

    def weighted(part: QueryBatch, broadcast: bool) -> DataFrame:
        return weighted_terms(query_terms(part.queries), index.term_stats, index.field_stats, boosts, broadcast)

    def found(scored: DataFrame) -> DataFrame:
        return top_k(scored, k).select("query_id", "rank", "doc_id", "score")

    def run(part: QueryBatch) -> DataFrame:
        terms = weighted(part, True)
        # the count of pairs is only worked out when it can exceed the bound
        if part.n_tokens * len(boosts) * n_docs > max_pairs and (terms.agg(F.sum("df")).first()[0] or 0) > max_pairs:
            post = reduce(DataFrame.unionByName, parts)
            return found(pruned_bm25(post, terms, k, list(boosts), params, should_weight * len(should or ())))
        wanted = _wanted_terms(part)
        return found(reduce(DataFrame.unionByName, [
            bm25(p if wanted is None else p.where(wanted), terms, list(boosts), params) for p in parts]))

    if batch.n_tokens * len(boosts) > max_broadcast_rows:
        post = reduce(DataFrame.unionByName, parts)
        return found(shuffled_bm25(post, weighted(batch, False), list(boosts), params))
    return batch.chunks(lambda part: part.n_queries * in_bucket, max_task_pairs, run)
