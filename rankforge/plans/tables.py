"""The given tables, seen as a corpus, its queries and their judgments."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.config import MAX_BROADCAST_ROWS
from rankforge.functions.text import tokens
from rankforge.functions.vectors import l2_normalise
from rankforge.operators.encode import HashingEncoder
from rankforge.plans.index import Index, build_index, exists, open_index
from rankforge.storage import materialize, prepared, shared_dir, spread

ENCODER = HashingEncoder(dim=64)
# Fixed cells that SQL can follow: a vector's cell is its largest component.
CENTRES = np.eye(ENCODER.dim)
# Per query, besides the documents that contain its passage, this many others
# are judged: the first two substitute, the next three complement, the rest not.
POOL = 10
# Cells of the fixed ones that a query looks into: recall over 0.9, see index_recall.
PROBES = 40


def _slug(sf_dir: str) -> str:
    return sf_dir.strip("/").replace("/", "_")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line as title, second as features, the rest as text."""
    lines = F.split("text", "\n", -1)
    return spread(read(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id",
        F.get(lines, 0).alias("title"),
        F.coalesce(F.get(lines, 1), F.lit("")).alias("features"),
        F.array_join(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), "\n").alias("text"),
        "lang", "source", "n_chars",
        F.array("lang", "source").alias("categories"),
        # made up: documents spread over the globe by their id
        F.struct((F.col("doc_id") * 37 % 181 - 90).cast("double").alias("lat"),
                 (F.col("doc_id") * 71 % 361 - 180).cast("double").alias("lon")).alias("location"),
    )


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def _containing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id) where the document holds the whole passage.

    The longest inner token of a passage, rare as long words are, picks the
    documents to compare; first and last token may be cut in the document.
    """
    toks = F.col("toks")
    inner = F.slice(toks, F.lit(2), F.greatest(F.size(toks) - 2, F.lit(0)))
    longest = F.array_max(F.transform(inner, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))
    passages = (
        queries(spark, sf_dir).withColumn("toks", tokens(F.col("query")))
        .select("query_id", "query", longest["t"].alias("anchor"))
    )
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    words = spread(docs, "doc_id").select("doc_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("anchor"))
    # texts join the pairs to compare, so that none is copied once per word; the
    # pairs, a few for each query, go to the texts
    pairs = materialize(words.join(passages.select("query_id", "anchor"), "anchor").select("query_id", "doc_id"), "anchored")
    n_pairs = pairs.agg(F.count(F.lit(1))).first()[0]
    texts = docs.join(F.broadcast(pairs) if n_pairs <= MAX_BROADCAST_ROWS else pairs, "doc_id").join(
        passages.select("query_id", "query"), "query_id")
    return texts.where(F.contains("text", "query")).select("query_id", "doc_id")


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments in the layout of a judged-query dataset, one per pair; written
    by the first job of a session that asks for them."""
    return prepared(spark, f"examples-{_slug(sf_dir)}", lambda: _judge(spark, sf_dir))


def _judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # the number of documents is one row
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    asked = queries(spark, sf_dir)
    pool = (
        asked.withColumn("n", n_docs)
        .select("query_id", "n", F.explode(F.sequence(F.lit(0), F.lit(POOL - 1))).alias("s"))
        .select(
            "query_id",
            ((F.col("query_id") * 7919 + F.col("s") * 104729) % F.col("n")).alias("doc_id"),
            F.when(F.col("s") < 2, 1).when(F.col("s") < 5, 2).otherwise(3).alias("level"),
        )
    )
    judged = (
        _containing(spark, sf_dir).withColumn("level", F.lit(0)).unionByName(pool)
        .groupBy("query_id", "doc_id").agg(F.min("level").alias("level"))
    )
    label = F.element_at(F.array(*map(F.lit, "ESCI")), F.col("level") + 1)
    facts = docs.select("doc_id", F.col("lang").alias("product_locale"),
                        (F.col("n_chars") < 2000).cast("int").alias("small_version"))
    return judged.join(facts, "doc_id").join(asked, "query_id").select(
        "query_id", "query", F.col("doc_id").alias("product_id"), "product_locale",
        label.alias("esci_label"), "small_version",
        F.when(F.col("query_id") % 4 != 0, "train").otherwise("test").alias("split"),
    )


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples(spark, sf_dir).select(
        "query_id", F.col("product_id").alias("doc_id"), F.col("esci_label").alias("label")
    )


def dirty_price(key: Column, price: Column) -> Column:
    """Prices the way catalogues deliver them, by the key's remainder."""
    plain = F.format_string("%.2f", price)
    return (
        F.when(key % 6 == 0, plain)
        .when(key % 6 == 1, F.concat(F.lit("$"), plain))
        .when(key % 6 == 2, F.format_number(price, 2))
        .when(key % 6 == 3, F.concat(F.lit("  "), plain, F.lit(" \n")))
        .when(key % 6 == 4, F.lit("None"))
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as raw product records, with the usual dirt."""
    key = F.col("p_partkey")
    return spread(read(spark, sf_dir, "part"), "p_partkey").select(
        "p_partkey",
        F.when(key % 13 == 0, "").otherwise(F.concat(F.lit("P"), key.cast("string"))).alias("parent_asin"),
        F.when(key % 11 == 0, "  ab ").otherwise(F.concat(F.lit(" "), "p_name", F.lit("\n"))).alias("title"),
        F.when(key % 5 != 0, F.array(F.concat(F.lit(" "), "p_brand"), F.lit(""), F.lit(None), "p_type")).alias("features"),
        F.when(key % 3 != 0, F.array("p_name", F.lit("  "), "p_brand")).alias("description"),
        F.col("p_type").alias("main_category"),
        F.when(key % 7 != 0, F.array("p_type", "p_brand")).alias("categories"),
        F.when(key % 4 != 0, F.col("p_brand")).alias("store"),
        dirty_price(key, F.col("p_retailprice")).alias("price"),
        (F.col("p_size") / 10).alias("average_rating"),
        F.when(key % 2 == 0, F.col("p_size").cast("bigint")).alias("rating_number"),
    )


def judged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in the layout of a judged-product table."""
    key = F.col("doc_id")
    docs = documents(spark, sf_dir)
    return docs.select(
        F.col("doc_id").alias("product_id"),
        F.when(key % 17 == 0, " a ").otherwise(F.col("title")).alias("product_title"),
        F.col("text").alias("product_description"),
        F.when(key % 5 != 0, F.concat(F.lit(" \n"), "features")).alias("product_bullet_point"),
        F.when(key % 3 == 0, "  ").otherwise(F.col("source")).alias("product_brand"),
        F.when(key % 4 != 0, F.concat("lang", F.lit(" "))).alias("product_color"),
        F.col("lang").alias("product_locale"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers at the (made-up) coordinates of their nation."""
    nation = F.col("c_nationkey").cast("double")
    return read(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_acctbal",
        F.struct((nation * 5 - 60).alias("lat"), (nation * 13 - 150).alias("lon")).alias("location"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", "label"
    )


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, embedding)``: the unit mean vector of every label. Sums run
    per (label, position), so no vector is gathered before it is added up."""
    per_position = (
        vectors(spark, sf_dir).select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    mean = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"])
    return per_position.groupBy("label").agg(mean.alias("mean")).select(
        F.col("label").alias("query_id"), l2_normalise(F.col("mean")).alias("embedding")
    )


def nation_accounts(spark: SparkSession, sf_dir: str, table: str, prefix: str) -> DataFrame:
    """Customers or suppliers as unit vectors of few dimensions, which cells part well."""
    parts = F.array(F.col(f"{prefix}_acctbal") / 10000, F.col(f"{prefix}_nationkey") / 25.0, F.lit(1.0))
    key = {"c": "c_custkey", "s": "s_suppkey"}[prefix]
    return spread(read(spark, sf_dir, table), key).select(F.col(key).alias("key"), l2_normalise(parts).alias("embedding"))


def resident_index(spark: SparkSession, sf_dir: str) -> Index:
    """The searchable tables of the documents: built by the first job that asks
    for them in a session, opened by the others."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-index-{_slug(sf_dir)}"
    if exists(spark, path):  # of this application: its input does not change
        return open_index(spark, path, ENCODER)
    return build_index(documents(spark, sf_dir), path, encoder=ENCODER, centres=CENTRES)
