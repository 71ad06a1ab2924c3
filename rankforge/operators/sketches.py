"""Corpus statistics that can be added up: a row of sketches for each part of a
corpus, stored, and merged when read, without the documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes of the sketches, and the errors to expect of them: the standard error of
# a distinct count, and how far the rank of a quantile may be off (99 %).
HLL_BITS, KLL_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (HLL_BITS / 2), 0.0165


def corpus_sketches(docs: DataFrame, terms: Column, by: Sequence[str]) -> DataFrame:
    """``(*by, n_docs, n_tokens, terms, lengths)``: counts, a sketch of the
    distinct ``terms`` (an array column) and one of the documents' lengths.

    Sketches are merged on the map side, so a part of any size shuffles a few
    kilobytes from each task. A document without terms counts, with length 0.
    """
    cut = docs.select(*by, terms.alias("_terms"))
    size = F.coalesce(F.size("_terms"), F.lit(0)).cast("bigint")
    whole = cut.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.greatest(size, F.lit(0))).alias("n_tokens"),
        F.kll_sketch_agg_bigint(F.greatest(size, F.lit(0)), KLL_K).alias("lengths"))
    distinct = cut.select(*(F.col(c).alias(f"_{c}") for c in by), F.explode("_terms").alias("_term")).groupBy(
        *(f"_{c}" for c in by)).agg(F.hll_sketch_agg("_term", HLL_BITS).alias("terms"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return whole.join(distinct, same, "left").select(*by, "n_docs", "n_tokens", "terms", "lengths")


def merged(sketches: DataFrame, by: Sequence[str] = (), quantile: float = 0.5) -> DataFrame:
    """``(*by, n_docs, n_tokens, n_terms, length)`` of stored sketches: the
    estimated number of distinct terms, and a ``quantile`` of the lengths."""
    return sketches.groupBy(*by).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("terms")), F.lit(0)).alias("n_terms"),
        F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("lengths"), F.lit(quantile)).alias("length"))
