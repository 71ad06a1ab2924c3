"""Time the headline jobs on ``$BENCH_SF_DIR`` and print one JSON line.

Index building is a job of its own (``index_build``); the searches run against
the built tables, as searches against a resident index do. Every job runs twice
in full; ``queries`` holds the second time, ``first_run`` the first, which also
pays for starting Python workers and compiling generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from rankforge import FunnelParams, build_index, prepare_queries, run_funnel
    from rankforge.operators import knn
    from rankforge.operators.fusion import hybrid_search, neural_search
    from rankforge.operators.lexical import lexical_search
    from rankforge.plans import evaluation, tables
    from rankforge.plans.queries import registry
    from rankforge.storage import shared_dir

    first_run: dict[str, float] = {}
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name: str, job) -> object:
        for into in (first_run, seconds):
            start = time.perf_counter()
            result = job()
            if isinstance(result, DataFrame):
                result.write.format("noop").mode("overwrite").save()
            into[name] = round(time.perf_counter() - start, 3)
        if isinstance(result, DataFrame):
            rows[name] = result.count()  # not timed
        return result

    docs, asked = tables.documents(spark, SF_DIR), tables.queries(spark, SF_DIR)
    n_docs, n_queries = docs.count(), asked.count()
    work = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    index = timed("index_build", lambda: build_index(
        docs, f"{work}/index", encoder=tables.ENCODER, n_cells=16, force=True))
    batch = prepare_queries(asked)
    timed("bm25_top100", lambda: lexical_search(index, batch, 100))
    timed("knn_top100", lambda: neural_search(index, batch, 100))
    timed("knn_cells_top100", lambda: neural_search(index, batch, 100, nprobe=4))
    timed("hybrid_top20", lambda: hybrid_search(index, batch, 20))
    timed("hybrid_filtered", lambda: hybrid_search(index, batch, 20, must={"lang": "en", "n_chars": {"gte": 200}}))
    timed("funnel", lambda: run_funnel(index, batch, params=FunnelParams()).documents)
    qrels = tables.qrels(spark, SF_DIR)
    qrels.count()

    def evaluate() -> DataFrame:
        runs = evaluation.collect_runs(index, batch, k=100, rerank_depth=25)
        return evaluation.variant_comparison(runs, qrels)

    timed("evaluate_4_variants", evaluate)
    timed("knn_all_pairs_top10", lambda: knn.exact_knn(
        tables.vectors(spark, SF_DIR),
        tables.vectors(spark, SF_DIR).withColumnRenamed("doc_id", "query_id").select("query_id", "embedding"), 10))
    for name in ("jsonl_tolerant_scan", "judged_clean", "term_stats", "hash_embedding", "token_length_histogram",
                 "upsert_latest", "qrels_dedupe", "dcg"):
        timed(name, lambda name=name: registry()[name](spark, SF_DIR))

    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "first_run": first_run, "rows": rows, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "rates": {
            "indexed_docs_per_sec": round(n_docs / seconds["index_build"], 1),
            "funnel_queries_per_sec": round(n_queries / seconds["funnel"], 1),
            "evaluated_query_variants_per_sec": round(4 * n_queries / seconds["evaluate_4_variants"], 1),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
