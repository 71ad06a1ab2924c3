"""Merkle manifest, ranked lexical search and substring removal against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from rankforge.llm import debruijn, merkle, presence

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(docs):
    """(doc_id, leaf) -> the other columns, from (doc_id, text, lang, source, n_chars) tuples."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, text):
        return h(*(field(v) for v in (d[0], d[3], d[2], d[4], text)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        for nodes in levels[:-1]:
            low = i - i % 3
            yield nodes[low:i], nodes[i + 1:low + 3]
            i //= 3

    by_source = defaultdict(list)
    for d in docs:
        by_source[d[3]].append((d[0] is not None, d[0] or 0, leaf(d, d[1]), d))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order]
    top = tree([t[-1][0] for t in trees])
    found = []
    for number, s in enumerate(order):
        for pos, (_, _, own, d) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = [*path(trees[number], pos), *path(top, number)]
            folded = own
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0 and d[1] is not None:
                folded = leaf(d, d[1].replace("\n", ""))
            for left, right in steps:
                folded = h(*left, folded, *right)
            proof = h(*(x for left, right in steps for x in left + right))
            found.append((d[0], own, trees[number][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(found, key=str)


def manifest_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("params", [
    merkle.MerkleParams(), merkle.MerkleParams(height=1, part_leaves=4), merkle.MerkleParams(height=2, part_leaves=20)])
def test_manifest_of_many_sources(spark, params):
    rng = random.Random(3)
    docs = [(i, rng.choice(["a\nb", "", None, "ünï\n\n", "x"]), rng.choice([None, "en"]),
             rng.choice([None, "", "a", "b", "é", "z", "Z"] + ["big"] * 9), rng.choice([None, 5])) for i in range(120)]
    docs += [(1000 + i, "t\n", "en", f"s{i:02d}", 1) for i in range(30)]
    assert manifest_rows(merkle.manifest(spark.createDataFrame(docs, DOCS), params)) == plain_manifest(docs)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_manifest_of_one_source(spark, n):
    docs = [(i, f"line {i}\nend", "en", "s", 3) for i in range(n)]
    found = manifest_rows(merkle.manifest(spark.createDataFrame(docs, DOCS), merkle.MerkleParams(height=1, part_leaves=3)))
    assert found == plain_manifest(docs)


def test_manifest_on_messy_rows_and_none(spark, messy, no_docs):
    rows = [tuple(r) for r in messy.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert manifest_rows(merkle.manifest(messy, merkle.MerkleParams(height=1, part_leaves=5))) == plain_manifest(rows)
    assert merkle.manifest(no_docs).count() == 0


def test_multiproof_is_least():
    rng = random.Random(5)
    for n in (1, 2, 5, 27, 31, 100):
        known = sorted(rng.sample(range(n), rng.randint(1, n)))
        lacking = set(merkle.missing(known, n, 0, 3))
        # a node is needed by a path if it is beside it; it is not sent if a known leaf lies under it
        needed, size, level, at = set(), n, 0, set(known)
        while size > 1:
            for i in at:
                needed |= {(level, j) for j in range(i // 3 * 3, min(i // 3 * 3 + 3, size))}
            at, size, level = {i // 3 for i in at}, -(-size // 3), level + 1
        derived = {(lv, i // 3 ** lv) for i in known for lv in range(level + 1)}
        assert lacking == needed - derived


def plain_search(docs, items, k=20):
    def terms(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    counts = [(d[0], Counter(terms(d[1]))) for d in docs]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(Counter)
    for item, text in set(items):
        asked[item].update(terms(text))
    found = {}
    for item, query in asked.items():
        scores = []
        for doc_id, c in counts:
            if doc_id is None or not c:
                continue
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // total
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in query.items() if t in c)
            if score > 0:
                scores.append((-score, doc_id))
        if item is not None:
            found[item] = [(d, -s) for s, d in sorted(scores)[:k]]
    return {i: r for i, r in found.items() if r}


def search_rows(df):
    found = defaultdict(list)
    for r in df.orderBy("item_id", "rank").collect():
        assert r["rank"] == len(found[r["item_id"]]) + 1
        found[r["item_id"]].append((r["doc_id"], r["score"]))
    return found


@pytest.mark.parametrize("params", [
    presence.SearchParams(), presence.SearchParams(k=3, item_bytes=200, block_docs=7, first_docs=1)])
def test_search(spark, messy, params):
    rng = random.Random(8)
    letters = [chr(97 + i) * 2 for i in range(26)]
    docs = [(i, " ".join(rng.choices(letters, range(26, 0, -1), k=rng.randint(0, 40)))) for i in range(300)]
    docs += [tuple(r) for r in messy.select("doc_id", "text").collect()]
    items = [(i, " ".join(rng.sample(letters, rng.randint(1, 20)))) for i in range(30)]
    # more terms than a word has bits, a term twice, other cases, another text of one id, a row twice, none at all
    items += [(50, " ".join(letters + [f"w{i}" for i in range(80)])), (51, "aa AA zz-aa"), (51, "bb"), (52, "cc"),
              (52, "cc"), (53, None), (54, ""), (None, "aa"), (55, "漢字 ünïcode"), (56, "unheard of")]
    found = presence.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
                            spark.createDataFrame(items, "item_id bigint, text string"), params)
    assert search_rows(found) == plain_search(docs, items, params.k)


def test_search_of_nothing(spark, no_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert presence.search(no_docs, items).count() == 0
    assert presence.search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def test_bounds_spare_documents():
    """Groups whose bound is below the k-th score are not scored."""
    import numpy as np

    n = 4000
    rng = np.random.default_rng(1)
    terms = [np.flatnonzero(rng.random(60) < 0.2) for _ in range(n)]
    starts = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
    flat = np.concatenate(terms)
    block = presence.Block(np.arange(n), np.full(n, 100), starts, flat, np.ones(len(flat), np.int64),
                           np.arange(1, 61) ** 2)
    best, query = presence.Best(20), np.array([3, 40, 55, 58, 59])
    scored = block.rank(query, np.ones(5, np.int64), best, 16)
    plain = np.array([sum((t + 1) ** 2 * (10 ** 9 // 2200) for t in own if t in query) for own in terms])
    assert best.ids.tolist() == np.lexsort((np.arange(n), -plain))[:20].tolist()
    assert scored < n // 10


def plain_dedup(docs, width=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    first = {}
    for (i, _), w in zip(docs, words):
        if i is not None:
            for p in range(len(w) - width + 1):
                key = tuple(w[p:p + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        if i is not None:
            for p in range(len(w) - width + 1):
                if first[tuple(w[p:p + width])] < i:
                    gone |= set(range(p, p + width))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def dedup_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    text = lambda n: [word() for _ in range(n)]
    common, long, short = text(130), text(700), text(50)
    docs = [text(rng.randint(0, 200)) for _ in range(25)]
    for i in range(40):
        # a passage found everywhere, parts of it, and two parts joined anew
        docs.append(text(rng.randint(0, 90)) + common + text(rng.randint(0, 90)))
        low = rng.randint(0, 60)
        docs.append(text(30) + common[low:low + rng.randint(45, 70)] + text(30))
    docs += [long, long, long[:400] + text(60) + long[400:], long[300:] + long[:300], short, text(5) + short + text(5)]
    docs += [short[:49], short[1:] + text(1), text(10) + long[5:64] + common[:70], long + long]
    # periodic texts, whose graph is a ring
    docs += [["la", "li", "lu"] * 60, ["li", "lu", "la"] * 40, ["la"] * 120, ["la"] * 51, text(9) + ["la"] * 70]
    rng.shuffle(docs)
    return [(i, "  ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("params", [
    debruijn.DedupParams(), debruijn.DedupParams(hot_share=3), debruijn.DedupParams(filter_bits=512),
    debruijn.DedupParams(window=20, seed=7)])
def test_substrings(spark, params):
    docs = passages(params.window)
    found = debruijn.dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6), params)
    assert dedup_rows(found) == plain_dedup(docs, params.window)


def test_substrings_on_messy_rows_and_none(spark, messy, no_docs):
    rows = [tuple(r) for r in messy.select("doc_id", "text").collect()]
    assert dedup_rows(debruijn.dedup(messy)) == plain_dedup(rows)
    assert debruijn.dedup(no_docs).count() == 0
    base = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(5, base), (6, f"so\n{base}  once more"), (None, base)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["kept"] for r in debruijn.dedup(docs).collect()} == {5: None, 6: "so once more", None: None}


def test_paths_end_where_texts_part(spark):
    """One passage in three documents is one path; a fourth that leaves it in the
    middle cuts it in two."""
    rng = random.Random(2)
    text = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    passage = text(400)

    def paths(docs):
        df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id bigint, text string")
        params = debruijn.DedupParams()
        shared = spark.sparkContext.broadcast(debruijn.repeated_filter(df, params))
        anchors = debruijn.examined(df, shared, params).select("row", "doc_id", "anchors").selectExpr(
            "row", "doc_id", "inline(anchors)")
        found = debruijn.compacted(debruijn.edges(anchors), params)
        return found.groupBy("path").count().count()

    three = [text(40) + passage + text(60) for _ in range(3)]
    assert paths(three) == 1
    assert paths([*three, text(30) + passage[:200] + text(80)]) == 2


def test_hashes_of_windows():
    import numpy as np

    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    for width in (1, 2, 19, 32, 50):
        found = debruijn.rolling(values, width, debruijn._B[0])
        plain = [sum(int(values[i + j]) * pow(int(debruijn._B[0]), j, 1 << 64) for j in range(width)) % (1 << 64)
                 for i in range(200 - width + 1)]
        assert found.tolist() == plain
        assert debruijn.sliding_min(values, width).tolist() == [
            values[i:i + width].min() for i in range(200 - width + 1)]
