"""Second-stage scoring of (query, document) pairs.

Only the shortlist is scored, so the scorer may be expensive. A scorer has a
``score(pairs, index, batch)`` method that adds ``ce_score`` to ``(query_id,
query, doc_id, doc_text, ..)`` rows; ``batch`` is the whole query table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.config import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, SCORE_DECIMALS
from rankforge.functions.text import bigrams, embedding_text, tokens
from rankforge.operators.batch import QueryBatch, prepare_queries
from rankforge.operators.hits import only_listed, worth_listing
from rankforge.storage import materialize


class PairScorer(Protocol):
    def score(self, pairs: DataFrame, index, batch: QueryBatch) -> DataFrame: ...


@dataclass(frozen=True)
class OverlapScorer:
    """The built-in scorer: idf-weighted share of the query's terms that the
    document has, plus ``bigram_weight`` times the share of its word pairs.

    Built-in functions on one row at a time; no shuffle of its own. It reads
    query and document together, as a neural pair scorer does, and stands in
    for one; it does not match its quality.
    """

    bigram_weight: float = 0.5

    def query_side(self, batch: QueryBatch, index) -> DataFrame:
        """``(query_id, _terms, _weights: map<term, w>, _total, _pairs)``; a term's
        weight comes from the field it is most frequent in."""
        queries = batch.queries
        terms = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
        wanted = terms.select("term").distinct()
        if batch.n_tokens <= MAX_BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        df = index.term_stats.join(wanted, "term").groupBy("term").agg(F.max("df").alias("df"))
        n_docs = index.field_stats.agg(F.max("n_docs").alias("n_docs")).scalar()
        weight = F.log1p(F.col("_n") / (F.coalesce("df", F.lit(0)) + 1.0))
        weighted = (
            terms.join(df, "term", "left")
            .withColumn("_n", n_docs)
            .withColumn("w", weight)
            .groupBy("query_id")
            .agg(
                F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "w")))).alias("_weights"),
                F.sum("w").alias("_total"),
            )
            .withColumn("_terms", F.map_keys("_weights"))
        )
        return queries.select(
            "query_id", bigrams(tokens(F.col("query"))).alias("_pairs")
        ).join(weighted, "query_id", "left")

    def score(self, pairs: DataFrame, index, batch: QueryBatch) -> DataFrame:
        side = self.query_side(batch, index)
        if batch.n_tokens <= MAX_BROADCAST_ROWS:
            side = F.broadcast(side)
        # the document's tokens stay outside the lambda, which would otherwise
        # cut them anew for every term of the query
        hit = F.aggregate(
            F.array_intersect("_terms", "_toks"), F.lit(0.0),
            lambda acc, t: acc + F.element_at("_weights", t),
        )
        coverage = F.when(F.col("_total") > 0, hit / F.col("_total"))
        common = F.size(F.array_intersect("_pairs", bigrams(F.col("_toks"))))
        share = F.when(F.size("_pairs") > 0, common / F.size("_pairs"))
        score = F.coalesce(coverage, F.lit(0.0)) + self.bigram_weight * F.coalesce(share, F.lit(0.0))
        return (
            pairs.join(side, "query_id", "left")
            .withColumn("_toks", tokens(F.col("doc_text")))
            .withColumn("ce_score", F.round(score, SCORE_DECIMALS))
            .drop("_toks", "_terms", "_weights", "_total", "_pairs")
        )


@dataclass(frozen=True)
class ArrowScorer:
    """A user's model: ``load()`` runs once per task and returns a function
    from two equally long lists (queries, texts) to scores."""

    load: Callable[[], Callable[[list[str], list[str]], np.ndarray]]
    batch_size: int = 32

    def score(self, pairs: DataFrame, index, batch: QueryBatch) -> DataFrame:
        names, load, size = pairs.columns, self.load, self.batch_size
        schema = T.StructType([*pairs.schema.fields, T.StructField("ce_score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for batch in batches:
                scores = []
                for low in range(0, batch.num_rows, size):
                    # only these pairs' texts become Python strings
                    q, d = (batch.column(c).slice(low, size).to_pylist() for c in ("query", "doc_text"))
                    scores += map(float, model(q, d))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(scores, pa.float64())],
                    [*names, "ce_score"],
                )

        return pairs.mapInArrow(run, schema)


def score_pairs(ranked: DataFrame, queries: DataFrame | QueryBatch, index,
                scorer: PairScorer | None = None, depth: int | None = None) -> DataFrame:
    """``(.., query_id, rank, doc_id, ce_score)`` for the first ``depth`` rows
    of each query.

    The shortlist has at most queries x depth rows. When that is under the
    broadcast bound it travels to the documents, whose texts then do not move,
    and a scan of many documents leaves out what it does not list; otherwise both
    sides are joined by document id.
    """
    batch = prepare_queries(queries)
    head = ranked if depth is None else ranked.where(F.col("rank") <= depth)
    keyed = head.select("query_id", "rank", "doc_id")
    bounded = depth is not None and batch.n_queries * depth <= MAX_BROADCAST_ROWS
    docs = index.docs.select("doc_id", "title", "features", "text")
    if bounded and worth_listing(docs, batch.n_queries * depth):
        keyed = materialize(keyed, "shortlist")
        docs = only_listed(docs, keyed, batch.n_queries * depth)
    with_text = (
        docs.join(F.broadcast(keyed) if bounded else keyed, "doc_id")
        .select("query_id", "rank", "doc_id",
                embedding_text(F.col("title"), F.col("features"), F.col("text")).alias("doc_text"))
    )
    asked = batch.queries.select("query_id", F.coalesce("query", F.lit("")).alias("query"))
    if batch.n_queries <= MAX_BROADCAST_ROWS and batch.n_bytes <= MAX_BROADCAST_BYTES:
        asked = F.broadcast(asked)
    pairs = with_text.join(asked, "query_id")
    scored = (scorer or OverlapScorer()).score(pairs, index, batch)
    return scored.select("query_id", "rank", "doc_id", F.col("ce_score").cast("double").alias("ce_score"))


def rerank(ranked: DataFrame, queries: DataFrame | QueryBatch, index,
           scorer: PairScorer | None = None, top_k: int | None = None,
           depth: int | None = None) -> DataFrame:
    """Re-sort by pair score: ``(query_id, rank, doc_id, ce_score,
    retrieval_rank, rank_delta)``. Equal scores keep the retrieval order;
    ``top_k`` None keeps all rows."""
    if top_k is not None and top_k < 1:
        raise ValueError("top_k must be at least 1, or None for all")
    order = Window.partitionBy("query_id").orderBy(F.desc("ce_score"), F.asc("retrieval_rank"))
    out = (
        score_pairs(ranked, queries, index, scorer, depth)
        .withColumnRenamed("rank", "retrieval_rank")
        .withColumn("rank", F.row_number().over(order))
        .withColumn("rank_delta", F.col("retrieval_rank") - F.col("rank"))
        .select("query_id", "rank", "doc_id", "ce_score", "retrieval_rank", "rank_delta")
    )
    return out if top_k is None else out.where(F.col("rank") <= top_k)


def head_and_tail(ranked: DataFrame, scores: DataFrame, depth, by: list[str] | None = None) -> DataFrame:
    """Re-sort the first ``depth`` rows of each query by score and leave the
    rest where it is: ``(*by, query_id, rank, doc_id)``. ``depth`` is a number,
    or a column of ``ranked`` to run several depths (named by ``by``) at once."""
    by = by or []
    depth = F.col(depth) if isinstance(depth, str) else F.lit(depth)
    joined = ranked.join(scores.select("query_id", "doc_id", "ce_score"), ["query_id", "doc_id"], "left")
    in_head = F.col("rank") <= depth
    order = Window.partitionBy(*by, "query_id").orderBy(
        (~in_head).cast("int"), F.when(in_head, -F.col("ce_score")), F.asc("rank")
    )
    return joined.select(*by, "query_id", F.row_number().over(order).alias("rank"), "doc_id")
