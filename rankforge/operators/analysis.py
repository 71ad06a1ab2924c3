"""Term tables for ranking, and token-length reports.

All tables are keyed by ``doc_id``. The raw text is shuffled once, by document;
after that term counts are local to a partition, and stay co-located with every
later step that groups by document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.config import EMBED_MAX_TOKENS
from rankforge.functions.text import embedding_text, tokens
from rankforge.storage import materialize, parts_of


def postings(docs: DataFrame, fields: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``(doc_id, field, term, tf, dl)``: how often each term occurs in each
    field of each document, with the length of that field in tokens. Without a
    number of ``partitions`` there are as many as keep a task's counts small,
    with 0 the documents stay where they are."""
    own = docs.select("doc_id", *fields)
    by_doc = own if partitions == 0 else own.repartition(partitions or parts_of(own), "doc_id")
    analysed = by_doc.select(
        "doc_id",
        F.explode(
            F.array(*(F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("toks")) for f in fields))
        ).alias("_f"),
    ).select("doc_id", "_f.field", F.size("_f.toks").alias("dl"), "_f.toks")
    return (
        analysed.select("doc_id", "field", "dl", F.explode("toks").alias("term"))
        .groupBy("doc_id", "field", "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.max("dl").cast("bigint").alias("dl"))
    )


def doc_lengths(post: DataFrame) -> DataFrame:
    return post.groupBy("doc_id", "field").agg(F.max("dl").alias("dl"))


def term_stats(post: DataFrame) -> DataFrame:
    """``(field, term, df)``: documents per term."""
    return post.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def field_stats(post: DataFrame) -> DataFrame:
    """``(field, n_docs, avgdl)`` over the documents with a term in the field."""
    return doc_lengths(post).groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"), (F.sum("dl") / F.count(F.lit(1))).alias("avgdl")
    )


def with_embedding_text(docs: DataFrame) -> DataFrame:
    return docs.withColumn(
        "embedding_text", embedding_text(F.col("title"), F.col("features"), F.col("text"))
    )


def token_counts(docs: DataFrame, count: Column | None = None) -> DataFrame:
    """``(doc_id, n_tokens)`` of the embedding text; ``count`` is a column of
    another tokenizer's counts, when the encoder has its own."""
    n = count if count is not None else F.size(tokens(F.col("embedding_text")))
    return with_embedding_text(docs).select("doc_id", n.cast("bigint").alias("n_tokens"))


def truncated(counts: DataFrame, max_tokens: int = EMBED_MAX_TOKENS) -> DataFrame:
    """Documents that lose their tail in the encoder's window."""
    return counts.where(F.col("n_tokens") > max_tokens)


def truncation_report(counts: DataFrame, max_tokens: int = EMBED_MAX_TOKENS,
                      show: int = 5) -> DataFrame:
    """One row: how many documents are cut, of how many, and the first few ids.

    Every partition hands on at most ``show`` ids (a top-n, not a collection).
    """
    over = F.col("n_tokens") > max_tokens
    counts = materialize(counts, "token-counts")  # two numbers per document, read twice
    totals = counts.agg(F.count_if(over).alias("n_over"), F.count(F.lit(1)).alias("n_docs"))
    firsts = (
        counts.where(over).orderBy("doc_id").limit(show)
        .agg(F.array_sort(F.collect_list("doc_id")).alias("first_ids"))
    )
    return totals.unionByName(firsts, allowMissingColumns=True).agg(
        F.max("n_over").alias("n_over"),
        F.max("n_docs").alias("n_docs"),
        F.max("first_ids").alias("first_ids"),
    )


def length_statistics(counts: DataFrame, max_tokens: int = EMBED_MAX_TOKENS) -> DataFrame:
    """Median token count and share over the window. Equal counts are summed
    first, so the exact median sees distinct lengths only."""
    per_length = counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n"))
    over = F.when(F.col("n_tokens") > max_tokens, F.col("n")).otherwise(0)
    return per_length.agg(
        F.sum("n").alias("n_docs"),
        F.percentile("n_tokens", 0.5, F.col("n")).alias("median_tokens"),
        F.round(F.sum(over) / F.sum("n"), 6).alias("share_over"),
    )


def length_histogram(counts: DataFrame, bins: int = 60) -> DataFrame:
    """Equal-width bins between the shortest and the longest text; the last bin
    includes the maximum."""
    per_length = materialize(counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")), "lengths")
    ends = per_length.agg(F.min("n_tokens").alias("lo"), F.max("n_tokens").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    scaled = F.floor((F.col("n_tokens") - lo) * bins / F.greatest(hi - lo, F.lit(1))).cast("int")
    return (
        per_length.select(F.least(scaled, F.lit(bins - 1)).alias("bin"), "n")
        .groupBy("bin").agg(F.sum("n").alias("n_docs"))
    )
