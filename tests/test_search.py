import dataclasses
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import rankforge as rf
from rankforge.functions import geo
from rankforge.operators import filters, fusion, hits, knn, lexical
from rankforge.operators.batch import prepare_queries

from articles import ARTICLES


def brute_bm25(boosts, texts, query, k1=1.2, b=0.75):
    import re

    cut = lambda s: re.findall(r"\w+", s.lower())
    best = defaultdict(float)
    for field, boost in boosts.items():
        docs = {i: cut(t[field]) for i, t in texts.items() if cut(t[field])}
        n, avg = len(docs), sum(map(len, docs.values())) / max(len(docs), 1)
        for i, d in docs.items():
            s = 0.0
            for term, qtf in Counter(cut(query)).items():
                df = sum(term in x for x in docs.values())
                if term in d:
                    tf = d.count(term)
                    s += qtf * math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + k1 * (1 - b + b * len(d) / avg))
            if s:
                best[i] = max(best[i], boost * s)
    return sorted(((round(s, 9), i) for i, s in best.items()), key=lambda p: (-p[0], p[1]))


def rows(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append(r)
    return out


@pytest.mark.parametrize("options", [{}, {"max_pairs": 0}, {"max_broadcast_rows": 3}])
def test_bm25_equals_brute_force(index, asked, options):
    texts = {a[0]: dict(zip(("title", "features", "text"), a[1:4])) for a in ARTICLES}
    found = rows(lexical.lexical_search(index, asked, 3, **options))
    for r in asked.collect():
        want = brute_bm25({"title": 2.0, "features": 1.0, "text": 1.0}, texts, r.query)[:3]
        assert [x.score for x in found[r.query_id]] == pytest.approx([s for s, _ in want])
        assert [x.doc_id for x in found[r.query_id]] == [i for _, i in want]


@pytest.mark.parametrize("k", [1, 3, 20])
@pytest.mark.parametrize("should", [None, {"lang": "x"}])
def test_pruned_search_equals_the_full_one(spark, tmp_path, k, should):
    rng = np.random.default_rng(k)
    # a Zipf-like vocabulary: the first words are in almost every document
    words = [f"w{i}" for i in range(300)]
    p = 1 / np.arange(1, 301)
    texts = [" ".join(rng.choice(words, 30, p=p / p.sum())) for _ in range(400)]
    docs = spark.createDataFrame(
        [(i, t.split(" ", 3)[0], "", t, "xy"[i % 2]) for i, t in enumerate(texts)],
        "doc_id bigint, title string, features string, text string, lang string")
    ix = rf.build_index(docs, str(tmp_path / "ix"), encoder=rf.HashingEncoder(dim=16), buckets=4)
    asked = spark.createDataFrame(
        [(q, " ".join(rng.choice(words, 6, p=p / p.sum())) + f" w{rng.integers(100, 300)}") for q in range(30)]
        + [(99, "w0 w1")], "query_id bigint, query string")
    full = lexical.lexical_search(ix, asked, k, should=should, max_pairs=10**12)
    pruned = lexical.lexical_search(ix, asked, k, should=should, max_pairs=0)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(full) == key(pruned)


def test_plan_shuffles_only_the_top_k(index, asked):
    found = lexical.lexical_search(index, prepare_queries(asked), 3, must={"kind": "garden"})
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "WindowGroupLimit" in final
    # the query terms and the k best rows per query; never the postings
    assert "Exchange hashpartitioning(doc_id" not in final


def test_cut_before_the_shuffle_at_any_k(index, asked):
    found = lexical.lexical_search(index, prepare_queries(asked), 5000)
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("WindowGroupLimit") >= 2


def test_cells_of_an_index(index, asked):
    """Cells that no query looks into are not read; text fields can be filtered."""
    one = asked.where("query_id = 1")
    plan = fusion.neural_search(index, one, 3, nprobe=1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell", plan)
    found = fusion.hybrid_search(index, asked, 5, must={"title": "Garden tools"}, nprobe=3)
    assert {r.doc_id for r in found.collect()} == {"a6"}
    assert rf.run_funnel(index, asked, "neural", nprobe=1, do_rerank=False).documents.count() > 0
    with pytest.raises(ValueError, match="with cells"):
        fusion.neural_search(dataclasses.replace(index, centres=None), asked, 3, nprobe=1)


def test_probe_queries(index, asked):
    found = rows(lexical.lexical_search(index, asked, 5))
    assert found[1][0].doc_id == "a1" and found[2][0].doc_id == "a2"
    assert found[3][0].doc_id == "a4" and 5 not in found


def test_filters(index, articles, asked):
    schema = articles.schema
    ids = lambda cond: {r.doc_id for r in articles.where(cond).collect()}
    hard = lambda must=None, near=None: ids(filters.hard_condition(schema, must, near))
    assert hard({"kind": "garden"}) == {"a5", "a6", "a8"}
    assert hard({"kind": ["ops", "empty"]}) == {"a2", "a4", "a7"}
    assert hard({"tags": "plants"}) == {"a5", "a6"}
    assert hard({"tags": ["tools", "knn"]}) == {"a1", "a6"}
    assert hard({"published_year": {"gte": 2024, "lt": 2026}, "kind": "ops"}) == {"a2", "a4"}
    assert hard(near={"distance": "1400 km", "lat": 10.0, "lon": 20.0}) == {"a1", "a2", "a8"}
    for bad in ({"published_year": {"gt": 1}}, {"published_year": {"gte": 1, "near": 2}}, {"kind": None}):
        with pytest.raises(ValueError):
            filters.hard_condition(schema, bad)
    with pytest.raises(ValueError):
        filters.soft_score(schema, {"published_year": {"gte": 1}})
    assert filters.hard_condition(schema) is None
    found = rows(lexical.lexical_search(index, asked, 5, must={"tags": "plants"}))
    assert {x.doc_id for x in found[4]} == {"a5", "a6"} and 1 not in found


def test_should_lifts_but_never_adds(index, asked):
    plain = rows(lexical.lexical_search(index, asked, 10))
    lifted = rows(lexical.lexical_search(index, asked, 10, should={"tags": ["tools"]}))
    for q in plain:
        assert {x.doc_id for x in plain[q]} == {x.doc_id for x in lifted[q]}
    before, after = ({x.doc_id: x.score for x in r[4]} for r in (plain, lifted))
    assert after["a6"] == pytest.approx(before["a6"] + 1) and after["a8"] == before["a8"]


def test_distance_units():
    assert geo.parse_distance("2km") == 2000 and geo.parse_distance("1 mi") == pytest.approx(1609.344)
    assert geo.parse_distance(500) == 500
    with pytest.raises(ValueError):
        geo.parse_distance("far")


def test_geo_box_never_cuts_a_hit(spark):
    rng = np.random.default_rng(5)
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(-90, 90, 3000), rng.uniform(-180, 180, 3000))]
    df = spark.createDataFrame(pts, "lat double, lon double")
    for lat0, lon0, m in ((52.0, 13.0, 2e6), (80.0, 170.0, 1.5e6), (-5.0, 179.0, 3e6), (0.0, 0.0, 9e6)):
        plain = geo.haversine_m(F.col("lat"), F.col("lon"), lat0, lon0) <= m
        assert df.where(geo.within(F.col("lat"), F.col("lon"), lat0, lon0, m)).count() == df.where(plain).count()


def make_vectors(spark, n=300, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[5] = m[6]  # an exact tie
    df = spark.createDataFrame([(i, v.tolist(), i % 7) for i, v in enumerate(m)],
                               "doc_id bigint, embedding array<float>, label int").repartition(5)
    return m.astype(np.float64), df


def brute_knn(m, q, k, allowed=None):
    s = np.round(m @ q, 9)
    ids = [i for i in np.lexsort((np.arange(len(s)), -s)) if allowed is None or i in allowed]
    return [int(i) for i in ids[:k]]


@pytest.mark.parametrize("max_bytes", [1 << 20, 200])
def test_exact_knn_equals_brute_force(spark, max_bytes):
    m, vectors = make_vectors(spark)
    queries = spark.createDataFrame([(i, m[i].tolist()) for i in (0, 5, 9, 40)], "query_id int, embedding array<double>")
    found = rows(knn.exact_knn(vectors, queries, 7, max_bytes=max_bytes))
    for i in (0, 5, 9, 40):
        assert [r.doc_id for r in found[i]] == brute_knn(m, m[i], 7)
    filtered = rows(knn.exact_knn(vectors, queries, 7, must={"label": 3}))
    for i in (0, 5, 9, 40):
        assert [r.doc_id for r in filtered[i]] == brute_knn(m, m[i], 7, set(range(3, 300, 7)))


def test_cells(spark):
    m, vectors = make_vectors(spark)
    queries = spark.createDataFrame([(i, m[i].tolist()) for i in range(20)], "query_id int, embedding array<double>")
    centres = knn.train_cells(vectors, 6)
    stored = knn.assign_cells(vectors, centres)
    cells = {r.doc_id: r.cell for r in stored.collect()}
    ranking = knn.rank_cells(m, centres)
    assert all(cells[i] == ranking[i, 0] for i in range(300))
    exact = rows(knn.exact_knn(vectors, queries, 5))
    everything = rows(knn.cell_knn(stored, queries, centres, 5, nprobe=6))
    some = rows(knn.cell_knn(stored, queries, centres, 5, nprobe=2))
    for i in range(20):
        assert everything[i] == exact[i]
        near = set(ranking[i, :2])
        assert [r.doc_id for r in some[i]] == brute_knn(m, m[i], 5, {d for d in cells if cells[d] in near})
    sweep = knn.cell_knn_sweep(stored, queries, centres, 5, [2, 6])
    assert {(r.query_id, r.rank, r.doc_id) for r in sweep.where("nprobe = 2").collect()} == {
        (i, r["rank"], r.doc_id) for i in some for r in some[i]}


def clustered(spark, n_groups=12, per_group=60, dim=16):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(n_groups, dim))
    m = np.repeat(centres, per_group, axis=0) + rng.normal(scale=0.05, size=(n_groups * per_group, dim))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[5] = 0  # a text without tokens
    return m, spark.createDataFrame(
        [(i, v.tolist(), i % 7) for i, v in enumerate(m)], "doc_id bigint, embedding array<double>, label int")


@pytest.mark.parametrize("max_bytes", [1 << 26, 2000])
def test_bounded_cells_lose_nothing(spark, max_bytes):
    m, vectors = clustered(spark)
    centres = knn.train_cells(vectors, 12)
    stored = knn.assign_cells(vectors, centres)
    bounds = knn.cell_bounds(knn.cell_stats(stored, centres), centres)
    asked = [m[i] for i in (0, 5, 100, 300, 719)] + [np.random.default_rng(1).normal(size=m.shape[1])]
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, embedding array<double>")
    exact = rows(knn.exact_knn(vectors, queries, 9))
    found = knn.bounded_knn(stored, queries, bounds, 9, max_bytes=max_bytes)
    assert rows(found.hits) == exact
    # a vector in a group far from the others needs few cells; one without direction all
    seen = {r.query_id: r for r in found.visits.collect()}
    assert all(seen[i].cells <= 4 and seen[i].vectors < len(m) / 2 for i in (0, 2, 3, 4)) and seen[1].cells == 12
    filtered = knn.bounded_knn(stored, queries, bounds, 9, must={"label": 3})
    assert rows(filtered.hits) == rows(knn.exact_knn(vectors, queries, 9, must={"label": 3}))
    more = knn.bounded_knn(stored, queries, bounds, 700)  # more than most cells hold
    assert rows(more.hits) == rows(knn.exact_knn(vectors, queries, 700))


def test_no_score_exceeds_its_limit(spark):
    m, vectors = make_vectors(spark)
    centres = knn.train_cells(vectors, 6)
    stored = knn.assign_cells(vectors, centres)
    bounds = knn.cell_bounds(knn.cell_stats(stored, centres), centres)
    cells = {r.doc_id: r.cell for r in stored.collect()}
    limits = bounds.limits(m)
    scores = m @ m.T
    for i in range(len(m)):
        assert (scores[:, i] <= limits[:, cells[i]]).all()


def test_bounded_search_of_an_index(index, asked):
    assert rows(fusion.neural_search(index, asked, 3, nprobe="bounded")) == rows(fusion.neural_search(index, asked, 3))
    near = rf.run_funnel(index, asked, "hybrid", nprobe="bounded").documents
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, rf.run_funnel(index, asked, "hybrid").documents.collect()))


def scan_rows(df, column):
    """Rows that the scans of a table with ``column`` gave to a finished query."""
    def descend(plan):
        if "AdaptiveSparkPlan" in plan.nodeName():
            return descend(plan.executedPlan())
        leaves, found = plan.collectLeaves(), 0
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if "QueryStage" in leaf.nodeName():
                found += descend(leaf.plan())
            elif re.search(rf"\[[^\]]*\b{column}#", leaf.simpleString(10_000)) and "Scan" in leaf.nodeName():
                found += leaf.metrics().get("numOutputRows").get().value()
        return found

    return descend(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def paged(spark, tmp_path_factory):
    """Many rare terms and small pages, so that statistics can leave pages out."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.format_string("t%05d", F.col("id") % 2000).alias("title"),
        F.lit("").alias("features"), F.format_string("common w%05d", "id").alias("text"))
    options = {"parquet.page.row.count.limit": "100", "parquet.block.row.count.limit": "500"}
    return rf.build_index(docs, str(tmp_path_factory.mktemp("paged") / "ix"), encoder=rf.HashingEncoder(dim=8),
                          buckets=4, options=options)


def test_query_terms_reach_the_postings(spark, paged):
    asked = spark.createDataFrame([(1, "w00017 t00033"), (2, "w03900 unknown")], "query_id int, query string")
    found = lexical.lexical_search(paged, asked, 5)
    assert {(r.query_id, r.doc_id) for r in found.collect()} == {(1, 17), (1, 33), (1, 2033), (2, 3900)}
    assert 0 < scan_rows(found, "tf") < paged.postings.count() / 5


def test_documents_that_are_not_listed_are_not_read(spark, paged, monkeypatch):
    assert not hits.worth_listing(paged.docs, 3)  # a small table is read as it is
    monkeypatch.setattr(hits, "PAGE_BYTES", 100)
    listed = spark.createDataFrame([(1, 1, 40), (1, 2, 41), (2, 1, 3999)], "query_id int, rank int, doc_id bigint")
    out = hits.attach_documents(listed, paged.docs, max_rows=3)
    assert {(r.doc_id, r.title) for r in out.collect()} == {(40, "t00040"), (41, "t00041"), (3999, "t01999")}
    assert 0 < scan_rows(out, "title") < 1000
    one = hits.only_listed(paged.docs, listed.where("doc_id = 40"), 1)
    assert one.count() == 1 and hits.only_listed(paged.docs, listed.limit(0), 1).count() == 0


def test_queries_beyond_the_broadcast(index, asked, paged, spark):
    plain = rows(lexical.lexical_search(index, asked, 4, should={"tags": ["tools"]}))
    many = lexical.lexical_search(index, asked, 4, should={"tags": ["tools"]}, max_broadcast_rows=0)
    assert rows(many) == plain
    # a term that every document and every query holds is cut, the postings are read once
    asked = spark.createDataFrame([(i, f"common w{i:05d}") for i in range(40)], "query_id int, query string")
    many = lexical.lexical_search(paged, asked, 3, max_broadcast_rows=0)
    assert rows(many) == rows(lexical.lexical_search(paged, asked, 3))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_postings") == 1


def test_shortfall(spark):
    m, vectors = make_vectors(spark)
    queries = spark.createDataFrame([(0, m[0].tolist())], "query_id int, embedding array<double>")
    before = knn.exact_knn(vectors, queries, 10, must={"label": 3})
    after = knn.exact_knn(vectors, queries, 10).join(vectors.where("label = 3").select("doc_id"), "doc_id", "left_semi")
    row = knn.filter_shortfall(before, after, queries).first()
    assert row.n_prefilter == 10 and row.n_postfilter < 10 and row.shortfall == 10 - row.n_postfilter


def ranked(spark, *lists):
    data = [(1, i, r, d) for i, ids in enumerate(lists) for r, d in enumerate(ids, 1)]
    return spark.createDataFrame(data, "query_id int, list_idx int, rank int, doc_id string")


def test_rrf_ties_weights_provenance(spark):
    lists = ranked(spark, "ab", "bac")
    got = fusion.fuse(lists, 2).withColumn("ranks", fusion.rank_map(2)).orderBy("rank").collect()
    assert [r.doc_id for r in got] == ["a", "b", "c"]
    assert got[0].rrf_score == got[1].rrf_score == pytest.approx(1 / 61 + 1 / 62)
    assert got[2].rrf_score == pytest.approx(1 / 63) and got[2].ranks == {1: 3} and got[0].ranks == {0: 1, 1: 2}
    only = fusion.fuse(ranked(spark, "dcb", "abc"), 2, weights=[1, 0]).orderBy("rank").collect()
    assert [r.doc_id for r in only] == ["d", "c", "b", "a"] and only[-1].rrf_score == 0
    sharp = fusion.fuse(ranked(spark, "ax", "bx"), 2, k=1).orderBy("rank").collect()
    assert [r.doc_id for r in sharp] == ["x", "a", "b"]
    twice = fusion.fuse(ranked(spark, "aba"), 1).where("doc_id = 'a'").first()
    assert twice.rrf_score == pytest.approx(1 / 61 + 1 / 63) and twice.rank_0 == 3
    with pytest.raises(ValueError):
        fusion.fuse(lists, 2, weights=[1])


def test_hybrid_union_and_encoder_check(index, asked):
    fused = fusion.hybrid_search(index, asked, 3)
    assert max(r["count"] for r in fused.groupBy("query_id").count().collect()) <= 6
    with pytest.raises(ValueError, match="encoded with"):
        fusion.neural_search(index, asked, 3, encoder=rf.HashingEncoder(dim=8))
    near = fusion.neural_search(index, asked, 3, nprobe=3)
    assert rows(near) == rows(fusion.neural_search(index, asked, 3))


def test_hits_leave_the_vector_out(index, asked):
    found = lexical.lexical_search(index, asked, 2)
    full = hits.attach_documents(found, index.vectors)
    assert "embedding" not in full.columns and {"kind", "tags", "score", "rank"} <= set(full.columns)


def test_arrow_encoder(spark, articles):
    def load():
        return lambda texts: np.array([[len(t), 1.0, 0.0] for t in texts])

    vectors = rf.attach_embeddings(articles, rf.ArrowEncoder("length", 3, load, batch_size=2)).collect()
    for r in vectors:
        assert np.linalg.norm(r.embedding) == pytest.approx(1, abs=1e-6)
    bad = rf.ArrowEncoder("bad", 4, load)
    with pytest.raises(Exception, match="expected 4"):
        rf.attach_embeddings(articles, bad).collect()


def test_hashing_encoder(spark):
    import hashlib

    enc = rf.HashingEncoder(dim=16, max_tokens=3)
    df = spark.createDataFrame([(1, "One two three four"), (2, ""), (3, "one two three")], "query_id int, query string")
    got = {r.query_id: r.embedding for r in rf.encode_queries(df, enc).collect()}
    want = np.zeros(16)
    for t in ("one", "two", "three"):
        h = hashlib.md5(t.encode()).hexdigest()
        want[int(h[:7], 16) % 16] += 1 if int(h[7], 16) < 8 else -1
    assert got[1] == pytest.approx(want / np.linalg.norm(want), abs=1e-6)
    assert got[2] == [0.0] * 16 and got[3] == got[1]


def test_whole_texts_are_encoded(spark):
    texts = [" ".join(["filler"] * 300), " ".join(["filler"] * 300 + ["tail"])]
    df = spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")
    whole, cut = rf.HashingEncoder(dim=16), rf.HashingEncoder(dim=16, max_tokens=256)
    assert len({tuple(r.embedding) for r in rf.encode_queries(df, whole).collect()}) == 2
    assert len({tuple(r.embedding) for r in rf.encode_queries(df, cut).collect()}) == 1


def test_repeated_ids_are_refused(spark, articles, tmp_path):
    with pytest.raises(ValueError, match="more than once"):
        prepare_queries(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "query_id int, query string"))
    path = str(tmp_path / "index")
    with pytest.raises(ValueError, match="comes more than once"):
        rf.build_index(articles.unionByName(articles.limit(1)), path, encoder=rf.HashingEncoder(dim=8), buckets=2)
    # the failed build is no index, and building again works
    built = rf.build_index(articles, path, encoder=rf.HashingEncoder(dim=8), buckets=2)
    assert built.docs.count() == articles.count()


def test_query_blocks_give_the_same_rows(spark, monkeypatch):
    from rankforge.operators import knn

    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id int, embedding array<double>")
    asked = docs.withColumnRenamed("doc_id", "query_id")
    whole = sorted(map(tuple, knn.exact_knn(docs, asked, 4).collect()))
    monkeypatch.setattr(knn, "BLOCK_SCORES", 100)
    assert sorted(map(tuple, knn.exact_knn(docs, asked, 4).collect())) == whole


def test_buckets_follow_the_measured_size(spark, articles):
    from rankforge.plans.index import default_buckets

    assert default_buckets(articles) == spark.sparkContext.defaultParallelism
