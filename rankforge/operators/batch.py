"""The query table, with the counts that decide how it is distributed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.text import tokens


@dataclass(frozen=True)
class QueryBatch:
    """``(query_id, query)`` rows, how many there are, and how many tokens and
    bytes of text they hold together. These bound every broadcast made from the
    table."""

    queries: DataFrame
    n_queries: int
    n_tokens: int
    n_bytes: int = 0

    def chunks(self, size: Callable[[QueryBatch], int], limit: int,
               run: Callable[[QueryBatch], DataFrame], level: int = 0) -> DataFrame:
        """``run`` over the whole table when its ``size`` is within ``limit``,
        else over hash chunks of the queries that are.

        Queries are independent of each other, so the union of the chunks is
        the exact result; each chunk costs one more pass over the documents.
        """
        total = size(self)
        if total <= limit or self.n_queries <= 1:
            return run(self)
        # twice as many chunks as needed: hashing does not cut evenly
        n = 2 * -(-total // limit)
        part = F.pmod(F.xxhash64(F.lit(level), "query_id"), F.lit(n))
        cuts = (prepare_queries(self.queries.where(part == i)) for i in range(n))
        return reduce(
            DataFrame.unionByName,
            [c.chunks(size, limit, run, level + 1) for c in cuts if c.n_queries],
        )


def prepare_queries(queries: DataFrame | QueryBatch) -> QueryBatch:
    """Count a query table once; a prepared one is returned as it is. Results
    are told apart by ``query_id`` alone, so an id that comes twice is an error."""
    if isinstance(queries, QueryBatch):
        return queries
    if "query" in queries.columns:
        n_tokens = F.coalesce(F.sum(F.size(tokens(F.col("query")))), F.lit(0))
        n_bytes = F.coalesce(F.sum(F.octet_length("query")), F.lit(0))
    else:
        n_tokens = n_bytes = F.lit(0)
    n, t, size, ids, nulls = queries.agg(
        F.count(F.lit(1)), n_tokens, n_bytes, F.count_distinct("query_id"),
        F.max(F.col("query_id").isNull().cast("int")),
    ).first()
    if ids + (nulls or 0) < n:
        raise ValueError(f"{n - ids} query ids come more than once")
    return QueryBatch(queries, int(n), int(t), int(size))


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, qtf)``: distinct terms of each query."""
    return (
        queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
