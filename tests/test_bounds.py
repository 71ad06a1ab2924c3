"""What one task holds does not grow with the tables."""

from pyspark.sql import functions as F

from rankforge import storage
from rankforge.operators import analysis, encode, lexical
from rankforge.plans import index as plans
from rankforge.plans import tables


def texts(spark, n, size=1):
    text = F.repeat(F.lit("some words "), F.lit(size))
    return spark.range(n).select(F.col("id").alias("doc_id"), text.alias("title"), F.lit("").alias("features"),
                                 F.lit("").alias("text"), F.lit("x").alias("lang"))


def test_larger_tables_have_more_parts(spark, tmp_path, monkeypatch):
    texts(spark, 3000).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    cores = spark.sparkContext.defaultParallelism
    assert storage.spread(docs, "doc_id").rdd.getNumPartitions() == cores
    monkeypatch.setattr(storage, "PART_BYTES", 500)
    for parted in (storage.spread(docs, "doc_id"), analysis.postings(docs, ["title"])):
        assert parted.rdd.getNumPartitions() > 2 * cores


def test_buckets_stay_small(spark):
    docs = texts(spark, 400, 100_000)  # 440 MB
    assert plans.default_buckets(docs) >= 30


def test_queries_are_cut_by_pairs_of_a_bucket(index, asked):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert index.buckets == 4
    whole = lexical.lexical_search(index, asked, 3)
    cut = lexical.lexical_search(index, asked, 3, max_task_pairs=4)
    assert rows(cut) == rows(whole) and whole.count() > 0
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("Union") >= 1


def test_only_kept_columns_meet_the_encoder(spark):
    made = encode.attach_embeddings(texts(spark, 5), encode.HashingEncoder(dim=8), keep=["doc_id"])
    assert made.columns == ["doc_id", "embedding"] and made.count() == 5
    assert len({tuple(r["embedding"]) for r in made.collect()}) == 1


def test_texts_do_not_move_to_the_passages(spark, tmp_path):
    spark.createDataFrame([(i, f"alpha unmistakable{i} beta gamma") for i in range(9)], "doc_id bigint, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "alpha unmistakable3 beta"), (2, "no unmistakable4 here")], "item_id bigint, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    found = tables._containing(spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [(1, 3)]
    assert "hashpartitioning(doc_id" not in found._jdf.queryExecution().executedPlan().toString()


def test_accounts_are_dealt_to_all_cores(spark, tmp_path):
    spark.createDataFrame([(i, i % 25, 10.0 * i) for i in range(50)], "c_custkey bigint, c_nationkey int, c_acctbal double") \
        .coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    made = tables.nation_accounts(spark, str(tmp_path), "customer", "c")
    assert made.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and made.count() == 50
