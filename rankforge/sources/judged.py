"""Judged queries: judgment examples, judged products, relevance tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.config import LABEL_GAINS, LABEL_GRADES, MIN_TITLE_CHARS
from rankforge.functions.text import blank_to_null, embedding_text, strip
from rankforge.operators.skew import attach_by_key

PRODUCT_COLUMNS = [
    "product_id", "product_title", "product_description", "product_bullet_point",
    "product_brand", "product_color", "product_locale",
]


def slice_examples(examples: DataFrame, locale: str = "us", small: bool = True,
                   splits: Sequence[str] | None = None) -> DataFrame:
    """Judgments of one locale, optionally of the small version and some splits."""
    out = examples.where(F.col("product_locale") == locale)
    if small:
        out = out.where(F.col("small_version") == 1)
    return out.where(F.col("split").isin(list(splits))) if splits else out


def read_examples(spark: SparkSession, path: str, **filters) -> DataFrame:
    return slice_examples(spark.read.parquet(path), **filters)


def read_products(spark: SparkSession, path: str, locale: str = "us") -> DataFrame:
    """Seven columns of one locale; both cuts reach the parquet scan."""
    return spark.read.parquet(path).select(*PRODUCT_COLUMNS).where(
        F.col("product_locale") == locale
    )


def clean_judged_products(raw: DataFrame) -> DataFrame:
    """Product rows to index documents; rows without id or title are dropped."""

    def txt(name: str) -> Column:
        is_text = raw.schema[name].dataType.simpleString() == "string"
        return strip(F.coalesce(name, F.lit(""))) if is_text else F.lit("")

    titled = raw.withColumn("_title", strip(F.col("product_title")))
    return titled.where(
        F.col("product_id").isNotNull()
        & (F.col("product_id").cast("string") != "")
        & (F.length("_title") >= MIN_TITLE_CHARS)
    ).select(
        F.col("product_id").alias("id"),
        F.col("_title").alias("title"),
        txt("product_bullet_point").alias("features"),
        txt("product_description").alias("text"),
        blank_to_null(txt("product_brand")).alias("brand"),
        blank_to_null(txt("product_color")).alias("color"),
        F.col("product_locale").alias("locale"),
    )


def restrict_to_judged(docs: DataFrame, examples: DataFrame, key: str = "product_id") -> DataFrame:
    """Documents that occur in at least one judgment."""
    return docs.join(examples.select(key), key, "left_semi")


def label_value(label: Column, values: Mapping[str, float], unknown_is_null: bool = False) -> Column:
    """Look a label up in a small fixed table; an unknown label stops the job."""
    out = None
    for name, value in values.items():
        out = F.when(label == name, value) if out is None else out.when(label == name, value)
    if unknown_is_null:
        return out
    problem = F.raise_error(F.concat(F.lit("unknown relevance label: "), F.coalesce(label, F.lit("null"))))
    return out.otherwise(problem.cast(type(next(iter(values.values()))).__name__))


def build_qrels(examples: DataFrame, split: str | None = "test",
                unknown_is_null: bool = False) -> DataFrame:
    """Judgments of the scored split with both gain conventions."""
    scored = examples.where(F.col("split") == split) if split else examples
    label = F.col("esci_label") if "esci_label" in examples.columns else F.col("label")
    return scored.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        "query",
        F.col("product_id").alias("doc_id"),
        label.alias("label"),
        label_value(label, LABEL_GAINS, unknown_is_null).alias("gain"),
        label_value(label, LABEL_GRADES, unknown_is_null).alias("graded"),
    )


def dedupe_qrels(qrels: DataFrame, order: str) -> DataFrame:
    """One judgment per (query, document): the last by ``order`` wins, and the
    query text is that of the query's first row. Both are running maxima and
    minima, so nothing is gathered per query."""
    rest = [c for c in qrels.columns if c not in ("query_id", "doc_id", "query", order)]
    last = qrels.groupBy("query_id", "doc_id").agg(
        F.max_by(F.struct(*rest), order).alias("_row"),
        F.min_by(F.struct("query"), order).alias("_q"),
        F.min(order).alias("_first"),
    )
    text = last.groupBy("query_id").agg(
        F.min_by("_q.query", "_first").alias("query"), F.count(F.lit(1)).alias("_n"))
    return attach_by_key(last, text, "query_id", "_n", ["query"]).select(
        "query_id", "query", "doc_id", *(F.col(f"_row.{c}").alias(c) for c in rest)
    )


def nest_qrels(qrels: DataFrame, part_rows: int = 1000) -> DataFrame:
    """``(query_id, query, part, judgments: map<doc_id, struct>)`` from a
    deduplicated table.

    A query with up to ``part_rows`` judgments is one row. One with more is
    spread over several parts by a hash of the document id, so that no task
    ever holds an unbounded map.
    """
    counts = qrels.groupBy("query_id").agg(
        F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_parts"), F.count(F.lit(1)).alias("_n")
    )
    rest = [c for c in qrels.columns if c not in ("query_id", "query", "doc_id")]
    return (
        attach_by_key(qrels, counts, "query_id", "_n", ["_parts"])
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("_parts")).cast("int"))
        # a join may have dealt by query; its parts are not to stay in one task
        .repartition("query_id", "part")
        .groupBy("query_id", "query", "part")
        .agg(F.map_from_entries(F.collect_list(F.struct("doc_id", F.struct(*rest)))).alias("judgments"))
    )


def slice_statistics(examples: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of judgments, distinct queries and distinct products."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return examples.agg(
        F.count(F.lit(1)).alias("n_judgments"),
        distinct(F.col("query_id")).alias("n_queries"),
        distinct(F.col("product_id")).alias("n_products"),
    )


def training_pairs(examples: DataFrame, docs: DataFrame, split: str = "train") -> DataFrame:
    """(query, document text, grade) rows of the training split."""
    pairs = build_qrels(examples, split=split).select("query_id", "query", "doc_id", "graded")
    texts = docs.select(
        F.col("id").alias("doc_id"),
        embedding_text(F.col("title"), F.col("features"), F.col("text")).alias("doc_text"),
    )
    return pairs.join(texts, "doc_id").select("query_id", "doc_id", "query", "doc_text", "graded")


def label_histogram(qrels: DataFrame) -> DataFrame:
    return qrels.groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("n"))
