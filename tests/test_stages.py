import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import rankforge as rf
from rankforge.operators import analyze, lexical, metrics
from rankforge.operators import rerank as R
from rankforge.plans import evaluation, funnel
from rankforge.plans.index import build_index, compact_index, exists, open_index, update_index
from rankforge.sources.catalogue import upsert
from rankforge.streaming.versions import append_versions, compact, current

from articles import ARTICLE_TYPE


def constant_scorer(value=1.0):
    return rf.ArrowScorer(lambda: lambda q, d: np.full(len(q), value))


def test_rerank(index, asked, spark):
    found = rf.hybrid_search(index, asked, 4)
    shortest_first = rf.ArrowScorer(lambda: lambda q, d: np.array([-float(len(t)) for t in d]), batch_size=2)
    out = rf.rerank(found, asked, index, shortest_first).collect()
    assert {r.rank_delta for r in out} != {0}
    assert all(r.rank_delta == r.retrieval_rank - r["rank"] for r in out)
    lengths = [r.ce_score for r in sorted(out, key=lambda r: (r.query_id, r["rank"])) if r.query_id == 4]
    assert lengths == sorted(lengths, reverse=True)
    assert rf.rerank(found, asked, index, top_k=1).count() == asked.count()
    # equal scores keep the retrieval order
    same = rf.rerank(found, asked, index, constant_scorer()).collect()
    assert all(r["rank"] == r.retrieval_rank and r.ce_score == 1.0 for r in same)
    assert rf.rerank(found.limit(0), asked, index).count() == 0
    with pytest.raises(ValueError):
        rf.rerank(found, asked, index, top_k=0)


def test_overlap_score(index, asked):
    found = lexical.lexical_search(index, asked, 5)
    best = {r.query_id: r for r in rf.rerank(found, asked, index, top_k=1).collect()}
    assert best[4].doc_id == "a8" and best[4].ce_score == pytest.approx(1.5)  # both words, in order
    assert best[1].ce_score == pytest.approx(1.0)  # one word: no pairs


def test_head_and_tail(spark):
    ranked = spark.createDataFrame([(1, r, f"d{r}") for r in range(1, 6)], "query_id int, rank int, doc_id string")
    scores = spark.createDataFrame([(1, "d1", 0.1), (1, "d2", 0.9), (1, "d3", 0.5)], "query_id int, doc_id string, ce_score double")
    order = lambda depth: [r.doc_id for r in R.head_and_tail(ranked, scores, depth).orderBy("rank").collect()]
    assert order(3) == ["d2", "d3", "d1", "d4", "d5"] and order(2) == ["d2", "d1", "d3", "d4", "d5"]


def test_funnel(index, asked):
    params = rf.FunnelParams(candidates=4, after_trim=3, rerank_top_k=2, final_k=1)
    result = rf.run_funnel(index, asked, "hybrid", params)
    assert result.documents.count() == 5
    trace = {(r.query_id, r.stage_no): r for r in result.trace.collect()}
    assert len(trace) == 20
    assert (trace[4, 1].n_in, trace[4, 2].n_in) == (4, trace[4, 1].n_out)
    assert (trace[4, 2].n_out, trace[4, 3].n_in, trace[4, 3].n_out, trace[4, 4].n_out) == (3, 2, 2, 1)
    final = {r.query_id: r.doc_id for r in result.documents.collect()}
    assert trace[3, 4].top_ids == [final[3]]
    skipped = rf.run_funnel(index, asked, "lexical", params, do_rerank=False)
    lines = {(r.query_id, r.stage_no): r for r in skipped.trace.withColumn("line", funnel.trace_text()).collect()}
    assert lines[5, 1].n_out == 0 and lines[5, 4].top_ids == []  # a query nothing matches
    assert lines[4, 3].stage == "3. rerank (skipped)" and lines[4, 3].n_in == lines[4, 2].n_out
    assert lines[1, 4].line == "4. final                  1 -> 1     top: a1"
    with pytest.raises(ValueError):
        rf.run_funnel(index, asked, "psychic")


def test_funnel_geo_filter(index, asked):
    near = {"distance": "200km", "lat": 10.0, "lon": 20.0}
    docs = rf.run_funnel(index, asked, "hybrid", geo=near).documents
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {"a1"}


def grades(spark, *g):
    return spark.createDataFrame([(1, i, float(x)) for i, x in enumerate(g, 1)], "query_id int, rank int, grade double")


def test_dcg(spark):
    row = metrics.dcg(grades(spark, 3, 2, 0, 1), ks=(None, 2)).first()
    assert row.dcg_all == pytest.approx(9.3235, abs=1e-4) and row.dcg_2 == pytest.approx(7 + 3 / math.log2(3))
    with pytest.raises(ValueError):
        metrics.dcg(grades(spark, 1), ks=(0,))


QRELS = "query_id int, doc_id string, label string"


def test_metrics(spark):
    qrels = spark.createDataFrame(
        [(1, "a", "E"), (1, "b", "S"), (1, "c", "I"), (1, "d", "E"), (2, "a", "I"), (3, "z", "E")], QRELS)
    run = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "x"), (1, 3, "b"), (2, 1, "a"), (9, 1, "a")], "query_id int, rank int, doc_id string")
    got = {r.query_id: r for r in metrics.evaluate_queries(run, qrels, ks=(2, 10, None), recall_ks=(10,)).collect()}
    ideal = 7 + 7 / math.log2(3) + 3 / 2
    assert set(got) == {1, 2}  # 9 was never judged, 3 was not asked
    assert got[1].ndcg_10 == got[1].ndcg_all == pytest.approx((7 + 3 / 2) / ideal)
    assert got[1].ndcg_2 == pytest.approx(7 / (7 + 7 / math.log2(3))) and got[1].recall_10 == 0.5
    assert got[2].ndcg_10 == 0 and got[2].recall_10 == 0
    asked = spark.createDataFrame([(1,), (2,), (3,), (9,)], "query_id int")
    mean = metrics.evaluate_run(run, qrels, ks=(10,), recall_ks=(10,), run_queries=asked).first()
    assert mean.n_queries == 3 and mean.recall_10 == pytest.approx(0.5 / 3)
    assert metrics.evaluate_run(run.where("query_id = 9"), qrels).count() == 0
    loose = metrics.evaluate_queries(run, qrels, ks=(10,), recall_ks=(10,), relevant=["E", "S"],
                                     grades={"E": 1, "S": 0, "C": 0, "I": 0}).where("query_id = 1").first()
    assert loose.recall_10 == pytest.approx(2 / 3) and loose.ndcg_10 == pytest.approx(1 / (1 + 1 / math.log2(3)))
    perfect = spark.createDataFrame([(1, 1, "a"), (1, 2, "d"), (1, 3, "b")], "query_id int, rank int, doc_id string")
    assert metrics.evaluate_queries(perfect, qrels, ks=(10,)).first().ndcg_10 == pytest.approx(1)
    doubled = spark.createDataFrame([(3, 1, "z"), (3, 2, "z")], "query_id int, rank int, doc_id string")
    assert metrics.evaluate_queries(doubled, qrels).first().recall_10 == 2.0  # a repeated result counts twice
    for empty in ({"grades": {}}, {"relevant": []}):
        with pytest.raises(ValueError):
            metrics.evaluate_queries(run, qrels, **empty)


def test_ideal_positions_without_depth_equal_a_sort(spark):
    rng = np.random.default_rng(3)
    judged = spark.createDataFrame(
        [(int(q), f"d{i}", float(rng.integers(0, 4))) for i in range(500) for q in (1, 2)],
        "query_id int, doc_id string, grade double")
    got = metrics.ideal_positions(judged, None).orderBy("query_id", "rank").collect()
    for q in (1, 2):
        mine = [r for r in got if r.query_id == q]
        assert [r["rank"] for r in mine] == list(range(1, 501))
        assert [r.grade for r in mine] == sorted((r.grade for r in mine), reverse=True)


def test_evaluation_invariants(index, asked, spark):
    qrels = spark.createDataFrame([(1, "a1", "E"), (2, "a2", "E"), (3, "a4", "E"), (3, "a3", "S"), (4, "a8", "E")], QRELS)
    runs = evaluation.collect_runs(index, asked, k=5, rerank_depth=3, score_depth=4)
    means = {r.variant: r for r in evaluation.variant_comparison(runs, qrels).collect()}
    assert set(means) == set(evaluation.VARIANTS)
    # reranking reorders, it never retrieves
    assert means["hybrid"].recall_100 == means["hybrid + rerank"].recall_100
    lost = analyze.coverage_change(runs.fused, runs.reranked()).agg(F.sum("n_lost"), F.sum("n_gained")).first()
    assert tuple(lost) == (0, 0)
    sweep = {r.weights: r.ndcg_10 for r in analyze.weight_sweep(runs.lists, qrels, asked).collect()}
    assert sweep["1:1"] == pytest.approx(means["hybrid"].ndcg_10) and len(sweep) == 5
    depths = {r.depth: r.ndcg_10 for r in analyze.depth_sweep(runs.fused, runs.scores, qrels, asked, (3, 4)).collect()}
    assert depths[3] == pytest.approx(means["hybrid + rerank"].ndcg_10)
    table = evaluation.variant_comparison(runs, qrels)
    change = {r.variant: r.pct_vs_baseline for r in analyze.relative_to_baseline(table, "lexical").collect()}
    assert change["lexical"] == 0.0


def test_index_is_kept_reopened_and_rebuilt(spark, articles, tmp_path):
    path, enc = str(tmp_path / "ix"), rf.HashingEncoder(dim=8)
    assert not exists(spark, path)
    build_index(articles, path, encoder=enc, buckets=2)
    again = build_index(articles.repartition(3), path, encoder=enc, buckets=2)
    assert again.docs.count() == 8 and again.version == 1  # the same input: nothing was written
    for t in spark.catalog.listTables():
        if t.name.startswith("rankforge_"):
            spark.sql(f"DROP TABLE {t.name}")  # as in a new session
    reopened = open_index(spark, path, enc)
    assert reopened.postings.count() > 0
    assert lexical.lexical_search(reopened, spark.createDataFrame([(1, "garden")], "query_id int, query string"), 5).count() == 2
    with pytest.raises(ValueError):
        open_index(spark, path, rf.HashingEncoder(dim=4))
    small = build_index(articles.limit(2), path, encoder=enc, buckets=2)
    assert small.docs.count() == 2 and small.version == 2
    assert reopened.docs.count() == 8  # readers keep the version they opened
    assert build_index(articles.limit(2), path, encoder=enc, buckets=2, force=True).version == 3
    assert build_index(articles, path, encoder=enc, fingerprint="march").version == 4
    assert build_index(articles.limit(1), path, encoder=enc, fingerprint="march").docs.count() == 8


def test_a_build_that_dies_leaves_the_version_before(spark, articles, tmp_path, monkeypatch):
    from rankforge.plans import index as module

    path, enc = str(tmp_path / "ix"), rf.HashingEncoder(dim=8)
    build_index(articles, path, encoder=enc, buckets=2, n_cells=2)
    for step in ("_write_stats", "_write_vectors", "_publish"):
        with monkeypatch.context() as broken:
            broken.setattr(module, step, lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                build_index(articles.limit(3), path, encoder=enc, buckets=2, n_cells=2)
            with pytest.raises(ZeroDivisionError):
                update_index(spark, path, articles.limit(3).withColumn("pos", F.lit(0)), encoder=enc)
        found = open_index(spark, path, enc)
        assert found.version == 1 and found.docs.count() == 8 and found.vectors.count() == 8
    assert build_index(articles.limit(3), path, encoder=enc, buckets=2, n_cells=2).docs.count() == 3


def same_index(new, want):
    for name in ("docs", "postings", "term_stats", "field_stats", "vectors"):
        left, right = getattr(new, name), getattr(want, name)
        right = right.select(*left.columns)
        assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0, name


def test_index_updates_equal_a_rebuild(spark, articles, asked, tmp_path):
    import os

    enc, path = rf.HashingEncoder(dim=8), str(tmp_path / "v1")
    first = build_index(articles, path, encoder=enc, buckets=3, n_cells=2)
    batches = [
        [("a5", "Spring again", "", "garden peas", "garden", ["peas"], 2026, (1.0, 1.0), 0),
         ("a5", "Spring at last", "", "garden beans", "garden", ["beans"], 2026, (1.0, 1.0), 1),
         ("b1", "A new garden", "", "fresh soil", "garden", [], 2026, (2.0, 2.0), 2)],
        [("b1", "An old garden", "", "stale soil", "garden", [], 2026, (2.0, 2.0), 0),
         ("a1", "Cut", "", "cache_lines", "search", [], 2020, (2.0, 2.0), 1)],
        [("a5", "", "", "", "garden", None, 2026, None, 0)],
    ]

    def files(folder):
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs
                if "_SUCCESS" not in f}

    before, corpus, n = files(path), articles, 1
    for rows in batches:
        batch = spark.createDataFrame(rows, ARTICLE_TYPE + ", pos int")
        corpus = upsert(corpus, batch, key="doc_id")
        new = update_index(spark, path, batch, encoder=enc, compact_share=10.0)
        n += 1
        want = build_index(corpus, str(tmp_path / f"v{n}"), encoder=enc, buckets=3, centres=new.centres)
        assert new.version == n and len(new.segments) == n
    same_index(new, want)
    # every search goes through the segments
    for found in (lambda ix: lexical.lexical_search(ix, asked, 4, must={"kind": "garden"}),
                  lambda ix: rf.hybrid_search(ix, asked, 4, nprobe="bounded")):
        assert sorted(map(tuple, found(new).collect())) == sorted(map(tuple, found(want).collect()))
    # what was written before is untouched, and so is the version that was open
    assert before.items() <= files(path).items()
    assert first.docs.count() == 8
    compact = compact_index(spark, path, encoder=enc)
    assert len(compact.segments) == 1 and compact.version == n + 1
    same_index(compact, want)
    again = update_index(spark, path, batch, encoder=enc, max_segments=1)
    assert len(again.segments) == 1 and again.version == n + 3
    same_index(again, want)
    assert update_index(spark, path, batch.limit(0), encoder=enc).version == n + 3


def test_stream_of_versions(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "id string, v int, pos bigint"
    spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], schema).write.parquet(source)
    for batch in ([], [("a", 2, 0), ("a", 3, 1), (None, 9, 2)]):
        if batch:
            spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        append_versions(stream, log, str(tmp_path / "checkpoint")).awaitTermination(60)
    assert {r.id: r.v for r in current(spark, log).collect()} == {"a": 3, "b": 1}
    # what is compacted is not read again, and later batches still win
    assert compact(spark, log) == 1 and compact(spark, log) == 1
    assert {r.id: r.v for r in current(spark, log).collect()} == {"a": 3, "b": 1}
    plan = current(spark, log)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch" in plan
    spark.createDataFrame([("b", 4, 5), ("c", 7, 6)], schema).write.mode("append").parquet(source)
    append_versions(spark.readStream.schema(schema).parquet(source), log, str(tmp_path / "checkpoint")).awaitTermination(60)
    assert {r.id: r.v for r in current(spark, log).collect()} == {"a": 3, "b": 4, "c": 7}
    assert compact(spark, log) == 2
    assert {r.id: r.v for r in current(spark, log).collect()} == {"a": 3, "b": 4, "c": 7}


def test_side_by_side_and_friends(spark):
    rank = "query_id int, rank int, doc_id string"
    left = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], rank)
    right = spark.createDataFrame([(1, 1, "b"), (1, 2, "c"), (1, 3, "a")], rank)
    both = {r["rank"]: (r.left_doc_id, r.right_doc_id) for r in analyze.side_by_side(left, right).collect()}
    assert both == {1: ("a", "b"), 2: ("b", "c"), 3: (None, "a")}
    shift = {r.doc_id: r.moved for r in analyze.rank_shift(left, right).collect()}
    assert shift == {"b": 1, "c": None, "a": -2}
    row = analyze.disagreement(left, right).first()
    assert (row.n_common, row.jaccard) == (2, pytest.approx(2 / 3))
    queries = spark.range(100).withColumnRenamed("id", "query_id")
    first, second = (sorted(r.query_id for r in analyze.query_sample(queries.repartition(p), 10).collect()) for p in (1, 7))
    assert first == second and len(first) == 10


def test_hot_keys_of_a_join(spark, monkeypatch):
    from rankforge.operators import skew

    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, -1)], "key string, x int")
    table = rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("least"))
    want = sorted(map(tuple, rows.join(table.drop("n"), "key").select("key", "x", "least").collect()))
    for share in (2, 1024):
        monkeypatch.setattr(skew, "HOT_SHARE", share)
        assert sorted(map(tuple, skew.attach_by_key(rows, table, "key", "n", ["least"]).collect())) == want


def test_sketches_of_parts_merge(spark):
    from rankforge.operators import sketches

    docs = spark.range(3000).select(
        (F.col("id") % 7).alias("part"), F.when(F.col("id") % 2 == 0, "a").alias("kind"),
        F.split(F.concat_ws(" ", F.sequence(F.lit(0), F.col("id") % 50)), " ").alias("words"))
    stored = sketches.corpus_sketches(docs, F.col("words"), ["kind", "part"])
    assert stored.count() == 14
    whole = sketches.merged(stored).first()
    assert (whole.n_docs, whole.n_tokens) == (3000, 3000 * 51 // 2)
    assert whole.n_terms == pytest.approx(50, rel=0.1) and 24 <= whole.length <= 27
    by_kind = {r.kind: r.n_docs for r in sketches.merged(stored, ["kind"]).collect()}
    assert by_kind == {"a": 1500, None: 1500}
    nothing = sketches.corpus_sketches(docs.limit(0), F.col("words"), ["kind"])
    assert sketches.merged(nothing, ["kind"]).count() == 0


def test_rejected_rows_are_counted_while_written(spark, tmp_path):
    from rankforge.sources import catalogue

    rows = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (4, "long"), (None, "long"), (None, None)], "id int, title string")
    path = str(tmp_path / "out")
    counts = catalogue.save_checked(rows, path, {"no id": F.col("id").isNull(), "no title": F.length("title") == 0})
    assert counts == {"kept": 3, "no id": 2, "no title": 1}
    assert sorted(r.id for r in catalogue.kept(spark, path).collect()) == [1, 3, 4]
    assert {(r.id, r.rejected) for r in catalogue.rejected(spark, path).collect()} == {(2, "no title"), (None, "no id")}


def test_written_products_prune_the_scan(spark, tmp_path):
    from rankforge.sources import catalogue, judged

    columns = [c for c in judged.PRODUCT_COLUMNS if c not in ("product_id", "product_locale")]
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("product_id"), *(F.lit("abc").alias(c) for c in columns),
        F.when(F.col("id") % 2 == 0, "us").otherwise("es").alias("product_locale"))
    path = str(tmp_path / "products")
    catalogue.save(rows, path, partition_by="product_locale", sort_by="product_id")
    found = judged.read_products(spark, path, "us")
    assert found.count() == 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(product_locale" in plan
    catalogue.save(rows.limit(1), path)
    assert spark.read.parquet(path).count() == 100
    catalogue.save(rows.limit(1), path, force=True)
    assert spark.read.parquet(path).count() == 1


def test_expected_winner(spark):
    rank = "query_id int, rank int, doc_id string"
    lexical_ = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], rank)
    neural = spark.createDataFrame([(1, 1, "b"), (2, 1, "c")], rank)
    probes = spark.createDataFrame(
        [(1, "b", "neural"), (2, "c", "neural"), (3, "d", "neural")], "query_id int, doc_id string, expected string")
    found = {r.query_id: (r.rank_lexical, r.rank_neural, r.winner, r.as_expected)
             for r in analyze.expected_winner({"lexical": lexical_, "neural": neural}, probes).collect()}
    assert found == {1: (2, 1, "neural", True), 2: (1, 1, "lexical", False), 3: (None, None, None, False)}


def test_recall_of_an_index(index, asked):
    found = {r.nprobe: (r.recall, r.worst) for r in evaluation.index_recall(index, asked, 4, [1, 3]).collect()}
    assert found[3] == (1.0, 1.0) and found[1][0] < 1
    assert evaluation.smallest_nprobe(index, asked, 4, target=1.0) <= 3
