"""The queries once more, as plain SQL for a second engine.

Written for DuckDB over views named after the tables. Common parts are common
table expressions, listed with the ones they read.
"""

from __future__ import annotations

# Common table expressions: name -> (reads, body).
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}
_ORACLES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, reads: str, body: str) -> None:
    _CTES[name] = (tuple(reads.split()), body.strip())


def _oracle(name: str, reads: str, body: str) -> None:
    _ORACLES[name] = (tuple(reads.split()), body.strip())


def _needed(reads: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in reads:
        if name not in seen:
            _needed(_CTES[name][0], seen)
            seen.append(name)
    return seen


def oracles() -> dict[str, str]:
    out = {}
    for name, (reads, body) in _ORACLES.items():
        parts = ",\n".join(f"{n} AS MATERIALIZED (\n{_CTES[n][1]}\n)" for n in _needed(reads, []))
        out[name] = f"WITH {parts}\n{body}" if parts else body
    return out


_WS = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def toks(x: str) -> str:
    return rf"regexp_extract_all(lower(coalesce({x}, '')), '[\p{{L}}\p{{N}}_]+')"


_EMB_TEXT = "concat_ws(chr(10)||chr(10), {})".format(
    ", ".join(f"nullif({strip(c)}, '')" for c in ("title", "features", "text"))
)

# Corpus, queries, judgments ---------------------------------------------------
_cte("docs", "", """
SELECT doc_id, coalesce(l[1], '') AS title, coalesce(l[2], '') AS features,
       coalesce(array_to_string(l[3:], chr(10)), '') AS text, lang, source, n_chars
FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)""")
_cte("asked", "", "SELECT item_id AS query_id, text AS query FROM benchmark")
_cte("judged", "asked", """
SELECT query_id, doc_id, min(level) AS level FROM (
  SELECT query_id, doc_id, 0 AS level FROM asked JOIN documents d ON contains(d.text, query)
  UNION ALL
  SELECT query_id, (query_id * 7919 + s * 104729) % (SELECT count(*) FROM documents),
         CASE WHEN s < 2 THEN 1 WHEN s < 5 THEN 2 ELSE 3 END
  FROM asked, (SELECT unnest(range(10)) AS s)
) GROUP BY ALL""")
_cte("examples", "asked judged", """
SELECT query_id, query, j.doc_id AS product_id, lang AS product_locale,
       substr('ESCI', level + 1, 1) AS esci_label, (n_chars < 2000)::int AS small_version,
       CASE WHEN query_id % 4 <> 0 THEN 'train' ELSE 'test' END AS split
FROM judged j JOIN documents d ON d.doc_id = j.doc_id JOIN asked USING (query_id)""")
_cte("qrels", "examples", """
SELECT query_id, product_id AS doc_id, esci_label AS label,
       CASE esci_label WHEN 'E' THEN 3 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END AS grade,
       CASE esci_label WHEN 'E' THEN 1.0 WHEN 'S' THEN 0.1 WHEN 'C' THEN 0.01 ELSE 0.0 END::DOUBLE AS gain
FROM examples""")

# Raw products -----------------------------------------------------------------
_cte("raw_products", "", """
SELECT p_partkey,
  CASE WHEN p_partkey % 13 = 0 THEN '' ELSE 'P' || p_partkey END AS id,
  CASE WHEN p_partkey % 11 = 0 THEN 'ab' ELSE p_name END AS title,
  CASE WHEN p_partkey % 5 <> 0 THEN p_brand || ' ' || p_type ELSE '' END AS features,
  CASE WHEN p_partkey % 3 <> 0 THEN p_name || ' ' || p_brand ELSE '' END AS text,
  p_type AS main_category,
  CASE WHEN p_partkey % 7 <> 0 THEN p_type || ' > ' || p_brand ELSE '' END AS categories,
  CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS store,
  CASE WHEN p_partkey % 6 < 4 THEN round(p_retailprice, 2) END AS price,
  p_size / 10 AS average_rating,
  CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END::bigint AS rating_number
FROM part""")
_CLEAN_PRODUCT = """
SELECT id, title, features, text, main_category, categories, store, price, average_rating, rating_number
FROM raw_products WHERE id <> '' AND length(title) >= 3"""

# Terms and BM25 ---------------------------------------------------------------
_cte("fields", "docs", f"""
SELECT doc_id, 'title' AS field, {toks('title')} AS t FROM docs
UNION ALL SELECT doc_id, 'features', {toks('features')} FROM docs
UNION ALL SELECT doc_id, 'text', {toks('text')} FROM docs""")
_cte("lens", "fields", "SELECT doc_id, field, len(t) AS dl FROM fields WHERE len(t) > 0")
_cte("fstats", "lens", "SELECT field, count(*) AS n_docs, sum(dl) / count(*) AS avgdl FROM lens GROUP BY field")
_cte("post", "fields", """
SELECT doc_id, field, term, count(*) AS tf
FROM (SELECT doc_id, field, unnest(t) AS term FROM fields) GROUP BY ALL""")
_cte("tstats", "post", "SELECT field, term, count(*) AS df FROM post GROUP BY ALL")
_cte("qterms", "asked", f"""
SELECT query_id, term, count(*) AS qtf
FROM (SELECT query_id, unnest({toks('query')}) AS term FROM asked) GROUP BY ALL""")
_cte("field_scores", "qterms post tstats fstats lens", """
SELECT query_id, p.doc_id, p.field,
  sum(qtf * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS s
FROM qterms q JOIN post p USING (term) JOIN tstats t ON t.field = p.field AND t.term = p.term
JOIN fstats f ON f.field = p.field JOIN lens l ON l.doc_id = p.doc_id AND l.field = p.field
GROUP BY ALL""")
_cte("bm25", "field_scores", """
SELECT query_id, doc_id, max(s * CASE field WHEN 'title' THEN 2 ELSE 1 END) AS s
FROM field_scores GROUP BY ALL""")


def ranked(source: str, score: str, k: int, where: str = "true", extra: str = "") -> str:
    """The k best rows per query of ``source`` as (query_id, doc_id, score, rank)."""
    return f"""
SELECT query_id, doc_id, score, rank{extra} FROM (
  SELECT query_id, doc_id, score{extra},
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::int AS rank
  FROM (SELECT query_id, doc_id, round({score}, 9) AS score{extra} FROM {source} WHERE {where})
) WHERE rank <= {k}"""


# Hashed vectors ---------------------------------------------------------------
def _hashed(key: str, source: str, text: str) -> str:
    return f"""
SELECT {key}, bucket, (s / sqrt(sum(s * s) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS w FROM (
  SELECT {key}, bucket, sum(sgn)::DOUBLE AS s FROM (
    SELECT {key}, ('0x' || substr(md5(t), 1, 7))::bigint % 64 AS bucket,
           CASE WHEN ('0x' || substr(md5(t), 8, 1))::bigint < 8 THEN 1 ELSE -1 END AS sgn
    FROM (SELECT {key}, unnest({toks(text)}) AS t FROM {source})
  ) GROUP BY ALL HAVING sum(sgn) <> 0)"""


_cte("doc_text", "docs", f"SELECT doc_id, {_EMB_TEXT} AS body FROM docs")
_cte("doc_vec", "doc_text", _hashed("doc_id", "doc_text", "body"))
_cte("query_vec", "asked", _hashed("query_id", "asked", "query"))
# every document has a cosine with every query, also a document without tokens
_cte("cosines", "doc_vec query_vec docs asked", """
SELECT a.query_id, d.doc_id, coalesce(c.s, 0.0) AS s
FROM asked a CROSS JOIN docs d LEFT JOIN (
  SELECT query_id, doc_id, sum(d.w * q.w) AS s FROM doc_vec d JOIN query_vec q USING (bucket) GROUP BY ALL
) c ON c.query_id = a.query_id AND c.doc_id = d.doc_id""")
_cte("lex20", "bm25", ranked("bm25", "s", 20))
_cte("vec20", "cosines", ranked("cosines", "s", 20))
_cte("lex100", "bm25", ranked("bm25", "s", 100))
_cte("vec100", "cosines", ranked("cosines", "s", 100))


def fused(lists: list[tuple[str, float]], k: int = 60, by: str = "") -> str:
    union = " UNION ALL ".join(
        f"SELECT query_id, doc_id, {i} AS i, rank, score, {float(w)}::DOUBLE AS w FROM {name}"
        for i, (name, w) in enumerate(lists)
    )
    return f"""
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, first)::int AS rank FROM (
  SELECT query_id, doc_id, round(sum(w / ({k} + rank)), 12) AS rrf_score, min(i * 100000 + rank) AS first,
         max(rank) FILTER (i = 0) AS rank_0, max(rank) FILTER (i = 1) AS rank_1,
         max(score) FILTER (i = 0) AS score_0, max(score) FILTER (i = 1) AS score_1
  FROM ({union}) GROUP BY query_id, doc_id)"""


_cte("fused20", "lex20 vec20", fused([("lex20", 1), ("vec20", 1)]))
_cte("fused100", "lex100 vec100", fused([("lex100", 1), ("vec100", 1)]))

# Pair scores ------------------------------------------------------------------
_cte("qweights", "asked tstats fstats", f"""
SELECT query_id, term, ln(1 + (SELECT max(n_docs) FROM fstats) / (coalesce(df, 0) + 1.0)) AS w
FROM (SELECT DISTINCT query_id, unnest({toks('query')}) AS term FROM asked)
LEFT JOIN (SELECT term, max(df) AS df FROM tstats GROUP BY term) USING (term)""")


def _pairs_of(t: str) -> str:
    """Distinct adjacent pairs of the list column ``t``."""
    return f"list_distinct(list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]))"


_cte("qpairs", "asked", f"SELECT query_id, {_pairs_of('t')} AS p FROM (SELECT query_id, {toks('query')} AS t FROM asked)")
_cte("dtoks", "doc_text", f"SELECT doc_id, t, {_pairs_of('t')} AS p FROM (SELECT doc_id, {toks('body')} AS t FROM doc_text)")


def pair_scores(source: str, depth: int) -> str:
    """(query_id, doc_id, rank, ce) of the first ``depth`` rows per query."""
    return f"""
SELECT h.query_id, h.doc_id, h.rank,
  round(coalesce(any_value(cov.s), 0) + 0.5 * coalesce(
    any_value(CASE WHEN len(q.p) > 0 THEN len(list_intersect(q.p, d.p))::DOUBLE / len(q.p) ELSE 0 END), 0), 9) AS ce
FROM (SELECT query_id, doc_id, rank FROM {source} WHERE rank <= {depth}) h
JOIN qpairs q ON q.query_id = h.query_id JOIN dtoks d ON d.doc_id = h.doc_id
LEFT JOIN (
  SELECT h.query_id, h.doc_id, sum(CASE WHEN list_contains(d.t, w.term) THEN w.w ELSE 0 END) / sum(w.w) AS s
  FROM {source} h JOIN dtoks d ON d.doc_id = h.doc_id JOIN qweights w ON w.query_id = h.query_id
  WHERE h.rank <= {depth} GROUP BY ALL
) cov ON cov.query_id = h.query_id AND cov.doc_id = h.doc_id
GROUP BY ALL"""


_cte("scores50", "fused100 qpairs dtoks qweights", pair_scores("fused100", 50))
_cte("reranked25", "fused100 scores50", """
SELECT query_id, doc_id, row_number() OVER (
  PARTITION BY query_id ORDER BY (f.rank > 25)::int, CASE WHEN f.rank <= 25 THEN -ce END, f.rank)::int AS rank
FROM fused100 f LEFT JOIN (SELECT query_id, doc_id, ce FROM scores50) USING (query_id, doc_id)""")
_cte("scores20", "fused20 qpairs dtoks qweights", pair_scores("fused20", 25))
_cte("resorted", "scores20", """
SELECT query_id, doc_id, ce, rank AS retrieval_rank,
       row_number() OVER (PARTITION BY query_id ORDER BY ce DESC, rank)::int AS new_rank FROM scores20""")


# Metrics ----------------------------------------------------------------------
def metric_rows(source: str, by: str = "", ks=(5, 10), rks=(10, 100), grade: str = "grade",
                relevant: str = "label = 'E'", asked: str | None = None) -> str:
    """Per-query metrics of ``source`` (by.., query_id, rank, doc_id). ``asked``
    names the (by.., query_id) rows that were asked."""
    b = f"{by}, " if by else ""
    rb = f"r.{by}, " if by else ""
    on = f"r.query_id = h.query_id{f' AND r.{by} = h.{by}' if by else ''}"
    at = lambda k: "true" if k is None else f"rank <= {k}"
    name = lambda k: "all" if k is None else str(k)
    gain = "(pow(2, coalesce({}, 0)) - 1) / log2(rank + 1)"
    got = [f"sum({gain.format(grade)}) FILTER ({at(k)}) AS d_{name(k)}" for k in ks]
    got += [f"count(*) FILTER ({relevant} AND {at(k)}) AS r_{name(k)}" for k in rks]
    best = [f"sum({gain.format('g')}) FILTER ({at(k)}) AS i_{name(k)}" for k in ks]
    out = [f"CASE WHEN i_{name(k)} > 0 THEN coalesce(d_{name(k)}, 0) / i_{name(k)} ELSE 0 END::DOUBLE AS ndcg_{name(k)}" for k in ks]
    out += [f"CASE WHEN n_rel > 0 THEN coalesce(r_{name(k)}, 0) / n_rel ELSE 0 END::DOUBLE AS recall_{name(k)}" for k in rks]
    best_cols = "".join(", " + x for x in best)
    return f"""
SELECT {rb}r.query_id, {', '.join(out)}
FROM ({asked or f'SELECT DISTINCT {b}query_id FROM {source}'}) r
LEFT JOIN (
  SELECT {b}s.query_id, {', '.join(got)}
  FROM {source} s LEFT JOIN qrels q ON q.query_id = s.query_id AND q.doc_id = s.doc_id GROUP BY ALL
) h ON {on}
JOIN (
  SELECT query_id, count(*) AS n_judged{best_cols} FROM (
    SELECT query_id, {grade} AS g, row_number() OVER (PARTITION BY query_id ORDER BY {grade} DESC) AS rank FROM qrels
  ) GROUP BY query_id) i ON i.query_id = r.query_id
JOIN (SELECT query_id, count(*) FILTER ({relevant}) AS n_rel FROM qrels GROUP BY query_id) n ON n.query_id = r.query_id"""


def rounded(source: str, keep: str, names: list[str]) -> str:
    return f"SELECT {keep}{', '.join(f'round({n}, 6) AS {n}' for n in names)} FROM ({source})"


def means(source: str, by: str, names: list[str], digits: bool = True) -> str:
    cols = ", ".join(f"round(avg({n}), 6) AS {n}" if digits else f"avg({n}) AS {n}" for n in names)
    b = f"{by}, " if by else ""
    return f"SELECT {b}count(*) AS n_queries, {cols} FROM ({source}) {f'GROUP BY {by}' if by else ''}"


_M = ["ndcg_5", "ndcg_10", "recall_10", "recall_100"]
_VARIANTS = [("lexical", "lex100"), ("neural", "vec100"), ("hybrid", "fused100"), ("hybrid + rerank", "reranked25")]
_cte("variants", "lex100 vec100 fused100 reranked25", " UNION ALL ".join(
    f"SELECT '{v}' AS variant, query_id, rank, doc_id FROM {t}" for v, t in _VARIANTS))
_ASKED_VARIANTS = "SELECT variant, query_id FROM asked, (VALUES {}) v(variant)".format(
    ", ".join(f"('{v}')" for v, _ in _VARIANTS))
_cte("per_variant", "variants qrels asked", metric_rows("variants", "variant", asked=_ASKED_VARIANTS))
_ASKED = "SELECT query_id FROM asked"

# A. sources, cleaning, sinks --------------------------------------------------
_oracle("doc_clean", "docs", f"""
SELECT doc_id::bigint AS doc_id, title, features, md5(text) AS text_md5, source AS store FROM (
  SELECT doc_id, {strip('title')} AS title, source,
    array_to_string(list_filter(list_transform(string_split(features, ' '), lambda x: {strip('x')}), lambda x: x <> ''), ' ') AS features,
    array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), ' ') AS text
  FROM docs) WHERE length(title) >= 3""")
_oracle("price_parse", "raw_products", "SELECT p_partkey, price FROM raw_products")
_oracle("product_clean", "raw_products", _CLEAN_PRODUCT)
_oracle("jsonl_tolerant_scan", "raw_products", _CLEAN_PRODUCT + " AND p_partkey % 7 <> 3")
_oracle("judged_clean", "docs", f"""
SELECT id, title, features, md5(text) AS text, brand, color, locale FROM (
  SELECT doc_id AS id, CASE WHEN doc_id % 17 = 0 THEN 'a' ELSE {strip('title')} END AS title,
    CASE WHEN doc_id % 5 <> 0 THEN {strip('features')} ELSE '' END AS features, {strip('text')} AS text,
    CASE WHEN doc_id % 3 <> 0 THEN source END AS brand, CASE WHEN doc_id % 4 <> 0 THEN lang END AS color, lang AS locale
  FROM docs) WHERE length(title) >= 3""")
_oracle("products_read_back", "docs", f"""
SELECT id, title, features, md5(text) AS text, brand, color, locale FROM (
  SELECT doc_id AS id, CASE WHEN doc_id % 17 = 0 THEN 'a' ELSE {strip('title')} END AS title,
    CASE WHEN doc_id % 5 <> 0 THEN {strip('features')} ELSE '' END AS features, {strip('text')} AS text,
    CASE WHEN doc_id % 3 <> 0 THEN source END AS brand, CASE WHEN doc_id % 4 <> 0 THEN lang END AS color, lang AS locale
  FROM docs WHERE lang = 'en') WHERE length(title) >= 3""")
_oracle("articles_read_back", "docs", """
SELECT 'doc-' || lpad(doc_id::varchar, greatest(4, length(doc_id::varchar))::int, '0') AS id, title,
  md5(text) AS text_md5, lang AS category, concat_ws(',', lang, source) AS tags, 2024 AS published_year,
  4.5::DOUBLE AS rating, lang AS city, lat, lon
FROM docs JOIN (VALUES ('en', 51.5::DOUBLE, -0.1::DOUBLE), ('de', 52.5, 13.4), ('fr', 48.9, 2.4), ('es', 40.4, -3.7))
  c(city, lat, lon) ON city = lang""")
_oracle("rejected_products", "raw_products", """
SELECT rejected, min(p_partkey) AS first_key, count(*) AS n_rows, count(*) AS n_observed FROM (
  SELECT p_partkey, CASE WHEN id = '' THEN 'no id' WHEN length(title) < 3 THEN 'short title' ELSE 'kept' END AS rejected
  FROM raw_products) GROUP BY rejected""")
_oracle("sketch_profile", "docs", f"""
SELECT lang, count(*) AS n_docs, sum(len(t))::bigint AS n_tokens, any_value(n) AS exact_terms,
  true AS terms_within_error, true AS median_within_error
FROM (SELECT lang, {toks('text')} AS t FROM docs) JOIN (
  SELECT lang, count(DISTINCT w) AS n FROM (SELECT lang, unnest({toks('text')}) AS w FROM docs) GROUP BY lang) USING (lang)
GROUP BY lang""")
_oracle("keyword_ignore_above", "docs", """
SELECT doc_id, CASE WHEN length(title) <= 256 THEN title END AS title_keyword FROM docs""")
_oracle("slice_filter", "examples", """
SELECT query_id, product_id, esci_label FROM examples
WHERE product_locale = 'en' AND small_version = 1 AND split = 'train'""")
_oracle("corpus_semi_join", "docs examples", f"""
SELECT id, title, brand, color FROM (
  SELECT doc_id AS id, CASE WHEN doc_id % 17 = 0 THEN 'a' ELSE {strip('title')} END AS title,
    CASE WHEN doc_id % 3 <> 0 THEN source END AS brand, CASE WHEN doc_id % 4 <> 0 THEN lang END AS color
  FROM docs WHERE lang = 'en' AND doc_id IN (SELECT product_id FROM examples WHERE product_locale = 'en')
) WHERE length(title) >= 3""")
_oracle("slice_statistics", "examples", """
SELECT count(*) AS n_judgments, count(DISTINCT query_id) AS n_queries, count(DISTINCT product_id) AS n_products
FROM examples""")
_oracle("corpus_profile", "docs", r"""
SELECT lang, count(*) AS n_docs, round(avg((features <> '')::int), 6) AS share_features,
  round(avg((text <> '')::int), 6) AS share_text,
  quantile_cont(len(regexp_split_to_array(trim(concat_ws(' ', title, features, text)), '\s+')), 0.5)::DOUBLE AS median_words
FROM docs GROUP BY lang""")
_oracle("qrels_build", "examples qrels", """
SELECT e.query_id, md5(query) AS query, doc_id, label, gain, grade::int AS graded
FROM examples e JOIN qrels q ON q.query_id = e.query_id AND q.doc_id = e.product_id WHERE split = 'test'""")
_oracle("qrels_dedupe", "", """
WITH loaded AS (
  SELECT l_suppkey AS query_id, l_returnflag AS query, l_partkey AS doc_id,
    CASE WHEN l_quantity > 40 THEN 'E' WHEN l_quantity > 25 THEN 'S' WHEN l_quantity > 10 THEN 'C' ELSE 'I' END AS label,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, l_returnflag) AS pos
  FROM lineitem)
SELECT query_id, query, doc_id, label FROM (
  SELECT query_id, doc_id, arg_max(label, pos) AS label FROM loaded GROUP BY ALL
) JOIN (SELECT query_id, arg_min(query, pos) AS query FROM loaded GROUP BY ALL) USING (query_id)""")
_oracle("qrels_nested", "qrels", """
SELECT query_id, 0 AS part, string_agg(lpad(doc_id::varchar, 9, '0') || ':' || label, ' ' ORDER BY doc_id) AS judgments
FROM qrels GROUP BY query_id""")
_oracle("training_pairs", "examples doc_text", """
SELECT query_id, doc_id, md5(query) AS query_md5, md5(body) AS text_md5,
  CASE esci_label WHEN 'E' THEN 3 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END AS graded
FROM examples JOIN doc_text ON doc_id = product_id WHERE split = 'train'""")
_oracle("label_histogram", "qrels", "SELECT query_id, label, count(*) AS n FROM qrels GROUP BY ALL")
_oracle("id_and_geo_lookup", "", """
SELECT 'doc-' || lpad(c_custkey::varchar, greatest(4, length(c_custkey::varchar))::int, '0') AS id,
  c_name AS title, c_mktsegment AS city, lat, lon
FROM customer JOIN (VALUES ('AUTOMOBILE', 5.0::DOUBLE, 11.0::DOUBLE), ('BUILDING', 10.0, 22.0),
  ('FURNITURE', 15.0, 33.0), ('HOUSEHOLD', 20.0, 44.0), ('MACHINERY', 25.0, 55.0)) s(city, lat, lon)
  ON city = c_mktsegment""")
_oracle("geo_distance_filter", "", """
SELECT c_custkey, round(m / 1000, 6) AS km FROM (
  SELECT c_custkey, 2 * 6371008.7714 * asin(sqrt(least(1.0, pow(sin(radians(lat - 10) / 2), 2)
         + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(lon - 20) / 2), 2)))) AS m
  FROM (SELECT c_custkey, c_acctbal, c_nationkey * 5.0 - 60 AS lat, c_nationkey * 13.0 - 150 AS lon FROM customer)
  WHERE c_acctbal >= 0) WHERE m <= 4000000""")
_cte("versions", "", """
SELECT o_custkey AS id, o_totalprice AS price, o_orderstatus AS status, o_orderkey AS pos,
       o_orderdate >= TIMESTAMP '1998-01-01' AS late FROM orders""")
_cte("batch", "versions", "SELECT CASE WHEN pos % 50 <> 0 THEN id END AS id, price, status, pos FROM versions WHERE late")
_oracle("upsert_latest", "versions batch", """
SELECT id, price, status FROM (
  SELECT id, price, status, row_number() OVER (PARTITION BY id ORDER BY late DESC, pos DESC) AS rn FROM (
    SELECT id, price, status, pos, false AS late FROM versions WHERE NOT late
    UNION ALL SELECT id, price, status, pos, true FROM batch WHERE id IS NOT NULL)
) WHERE rn = 1""")
_oracle("upsert_outcome", "versions batch", """
SELECT (SELECT count(*) FROM batch WHERE id IS NOT NULL) AS succeeded, ins AS inserted,
  (SELECT count(*) FROM batch WHERE id IS NOT NULL) - ins AS updated,
  (SELECT count(*) FROM batch WHERE id IS NULL) AS rejected
FROM (SELECT count(DISTINCT id) AS ins FROM batch
      WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM versions WHERE NOT late))""")
_oracle("doc_count", "", "SELECT count(*) AS n_docs FROM documents")
_oracle("first_n", "", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 100")

# B. text, tokens, vectors -----------------------------------------------------
_cte("counts", "doc_text", f"SELECT doc_id, len({toks('body')}) AS n_tokens FROM doc_text")
_oracle("embedding_texts", "doc_text", """
SELECT doc_id, md5(body) AS text_md5, length(body)::int AS n_chars FROM doc_text""")
_oracle("truncation_report", "counts", """
SELECT count(*) FILTER (n_tokens > 256) AS n_over, count(*) AS n_docs,
  (SELECT string_agg(doc_id::varchar, ',' ORDER BY doc_id)
   FROM (SELECT doc_id FROM counts WHERE n_tokens > 256 ORDER BY doc_id LIMIT 5)) AS first_ids
FROM counts""")
_oracle("token_length_stats", "counts", """
SELECT count(*) AS n_docs, quantile_cont(n_tokens, 0.5)::DOUBLE AS median_tokens,
  round(avg((n_tokens > 256)::int), 6) AS share_over FROM counts""")
_oracle("token_length_histogram", "counts", """
SELECT least(59, floor((n_tokens - lo) * 60 / greatest(hi - lo, 1)))::int AS bin, count(*) AS n_docs
FROM counts, (SELECT min(n_tokens) AS lo, max(n_tokens) AS hi FROM counts) GROUP BY ALL""")
_oracle("term_stats", "tstats", "SELECT field, term, df FROM tstats")
_oracle("field_stats", "fstats", "SELECT field, n_docs, round(avgdl, 6) AS avgdl FROM fstats")
_oracle("l2_normalised", "", """
SELECT vec_id AS doc_id, (i - 1)::int AS pos,
  round(embedding[i]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS x
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
_oracle("hash_embedding", "doc_vec", "SELECT doc_id, bucket::int AS bucket, round(w, 6) AS weight FROM doc_vec")
_oracle("query_encode", "query_vec", "SELECT query_id, bucket::int AS bucket, round(w, 6) AS weight FROM query_vec")

# C. predicates ----------------------------------------------------------------
_DOC_FILTER = "lang IN ('en', 'de') AND n_chars >= 200 AND n_chars < 20000 AND source = 'src7'"
for _name, _where in {
    "filter_term": "lang = 'de'",
    "filter_terms": "source IN ('src1', 'src7', 'src19')",
    "filter_array_any": "source = 'src3' OR lang = 'fr'",
    "filters_all": _DOC_FILTER,
}.items():
    _oracle(_name, "", f"SELECT doc_id, lang, source FROM documents WHERE {_where}")
_oracle("filter_range", "", """
SELECT p_partkey, p_size, p_retailprice FROM part
WHERE p_size >= 10 AND p_size <= 30 AND p_retailprice >= 900.5 AND p_retailprice < 1000""")

# D. retrieval -----------------------------------------------------------------
_oracle("index_build", "docs post tstats fstats", """
SELECT 'docs' AS table_name, count(*) AS n_rows FROM docs UNION ALL SELECT 'postings', count(*) FROM post
UNION ALL SELECT 'term_stats', count(*) FROM tstats UNION ALL SELECT 'field_stats', count(*) FROM fstats
UNION ALL SELECT 'vectors', count(*) FROM docs""")


def hits(source: str, extra: str = "") -> str:
    return f"SELECT query_id, rank, doc_id, round(score, 6) AS score{extra} FROM ({source})"


_cte("text_scores", "field_scores", "SELECT query_id, doc_id, s FROM field_scores WHERE field = 'text'")
_oracle("bm25_single_field", "text_scores", hits(ranked("text_scores", "s", 10)))
_oracle("bm25_best_fields", "bm25", hits(ranked("bm25", "s", 10)))
_oracle("bm25_pruned", "bm25", hits(ranked("bm25", "s", 10)))
_oracle("bm25_shuffled", "bm25", hits(ranked("bm25", "s", 10)))
_oracle("index_update", "bm25", hits(ranked("bm25", "s", 10)))
_oracle("bm25_deep", "bm25", hits(ranked("bm25", "s", 2000)))
_cte("bm25_docs", "bm25 docs", "SELECT b.*, title, lang, source, n_chars FROM bm25 b JOIN docs USING (doc_id)")
_oracle("lexical_search", "bm25_docs", hits(
    ranked("bm25_docs", "s", 20, _DOC_FILTER, ", title, lang, source"), ", title, lang, source"))
_BONUS = "s + (source = 'src3')::int + (lang = 'fr' OR source = 'src9')::int"
_oracle("lexical_should", "bm25_docs", hits(ranked("bm25_docs", _BONUS, 20, "lang IN ('en', 'fr', 'es')")))
_cte("positions", "", """
SELECT vec_id AS doc_id, label, i AS pos, embedding[i]::DOUBLE AS x
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
_cte("centroids", "positions", """
SELECT query_id, pos, m / sqrt(sum(m * m) OVER (PARTITION BY query_id)) AS x
FROM (SELECT label AS query_id, pos, avg(x) AS m FROM positions GROUP BY ALL)""")
_cte("sims", "positions centroids", """
SELECT query_id, doc_id, any_value(label) AS label, sum(p.x * c.x) AS s
FROM positions p JOIN centroids c USING (pos) GROUP BY query_id, doc_id""")
_oracle("knn_exact", "sims", hits(ranked("sims", "s", 10)))
_oracle("knn_cells_all", "sims", hits(ranked("sims", "s", 10)))
_oracle("knn_cells_exact", "sims", hits(ranked("sims", "s", 10)))


def _account(table: str, prefix: str, key: str) -> str:
    return f"""
SELECT {key} AS key, a / n AS x, b / n AS y, 1 / n AS z FROM (
  SELECT *, sqrt(a * a + b * b + 1) AS n FROM (
    SELECT {key}, {prefix}_acctbal / 10000 AS a, {prefix}_nationkey / 25.0::DOUBLE AS b FROM {table}))"""


_cte("accounts", "", f"""
SELECT s.key AS query_id, c.key AS doc_id, c.x * s.x + c.y * s.y + c.z * s.z AS s
FROM ({_account("customer", "c", "c_custkey")}) c CROSS JOIN ({_account("supplier", "s", "s_suppkey")}) s""")
_oracle("knn_cells_unread", "accounts", f"SELECT *, true AS cells_unread FROM ({hits(ranked('accounts', 's', 5))})")
_oracle("knn_filtered", "sims", hits(ranked("sims", "s", 10, "label IN (1, 4, 7)")))
_cte("knn10", "sims", ranked("sims", "s", 10, "true", ", label"))
_oracle("knn_prefilter_vs_postfilter", "sims knn10", f"""
SELECT query_id, pre AS n_prefilter, coalesce(post, 0) AS n_postfilter, pre - coalesce(post, 0) AS shortfall
FROM (SELECT query_id, count(*) AS pre FROM ({ranked('sims', 's', 10, 'label IN (1, 4, 7)')}) GROUP BY query_id)
LEFT JOIN (SELECT query_id, count(*) AS post FROM knn10 WHERE label IN (1, 4, 7) GROUP BY query_id) USING (query_id)""")
_cte("cells", "sims", """
SELECT doc_id, query_id AS cell FROM (
  SELECT doc_id, query_id, row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 9) DESC, query_id) AS rn FROM sims)
WHERE rn = 1""")
_cte("probes", "centroids", """
SELECT query_id, cell, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, cell) AS place FROM (
  SELECT a.query_id, b.query_id AS cell, sum(a.x * b.x) AS s
  FROM centroids a JOIN centroids b USING (pos) GROUP BY ALL)""")
_cte("probed", "sims cells probes", """
SELECT s.query_id, s.doc_id, s.s, place FROM sims s JOIN cells c ON c.doc_id = s.doc_id
JOIN probes p ON p.query_id = s.query_id AND p.cell = c.cell""")
_oracle("knn_cells", "probed", hits(ranked("probed", "s", 10, "place <= 3")))
_oracle("ann_recall_sweep", "probed knn10", " UNION ALL ".join(f"""
SELECT {n} AS nprobe, round(count(*) FILTER (t.doc_id IS NOT NULL) / (SELECT count(*) FROM knn10), 6) AS recall_10
FROM ({ranked('probed', 's', 10, f'place <= {n}')}) a
LEFT JOIN knn10 t ON t.query_id = a.query_id AND t.doc_id = a.doc_id""" for n in (1, 2, 4, 8, 10)))
_cte("cosine_docs", "cosines docs", "SELECT c.*, lang, source, n_chars FROM cosines c JOIN docs USING (doc_id)")
_oracle("neural_search", "cosine_docs", hits(ranked("cosine_docs", "s", 20, "lang IN ('en', 'de')")))

# E. fusion --------------------------------------------------------------------
_FUSED = "SELECT query_id, rank, doc_id, round(rrf_score, 6) AS rrf_score FROM ({})"
_oracle("rrf", "fused20", _FUSED.format("SELECT * FROM fused20"))
_oracle("rrf_weighted", "lex20 vec20", _FUSED.format(fused([("lex20", 1), ("vec20", 0)])))
_oracle("rrf_ranks", "fused20", """
SELECT query_id, doc_id, rank_0 AS lex_rank, rank_1 AS vec_rank,
  round(score_0, 6) AS lex_score, round(score_1, 6) AS vec_score FROM fused20""")
_cte("lex_src7", "bm25_docs", ranked("bm25_docs", "s + (source = 'src7')::int", 20, _DOC_FILTER))
_cte("vec_src7", "cosine_docs", ranked("cosine_docs", "s", 20, _DOC_FILTER))
_oracle("hybrid_search", "lex_src7 vec_src7", _FUSED.format(fused([("lex_src7", 1), ("vec_src7", 2)])))



def _largest(key: str, rows: str, vectors: str) -> str:
    """The components of every vector, zeros too, by size, as cells."""
    return f"""
SELECT a.{key}, b.cell, row_number() OVER (PARTITION BY a.{key} ORDER BY round(coalesce(w, 0), 9) DESC, b.cell) AS place
FROM {rows} a CROSS JOIN (SELECT unnest(range(64)) AS cell) b
LEFT JOIN {vectors} v ON v.{key} = a.{key} AND v.bucket = b.cell"""


_cte("doc_cells", "docs doc_vec", _largest("doc_id", "docs", "doc_vec"))
_cte("query_cells", "asked query_vec", _largest("query_id", "asked", "query_vec"))
_cte("near_docs", "cosines doc_cells query_cells", """
SELECT c.query_id, c.doc_id, c.s FROM cosines c JOIN doc_cells d ON d.doc_id = c.doc_id AND d.place = 1
JOIN query_cells q ON q.query_id = c.query_id AND q.cell = d.cell AND q.place <= 40""")
_cte("near20", "near_docs", ranked("near_docs", "s", 20))
_cte("fused_near", "lex20 near20", fused([("lex20", 1), ("near20", 1)]))
_cte("swept", "cosines doc_cells query_cells", """
SELECT c.query_id, c.doc_id, c.s, q.place FROM cosines c JOIN doc_cells d ON d.doc_id = c.doc_id AND d.place = 1
JOIN query_cells q ON q.query_id = c.query_id AND q.cell = d.cell""")
_oracle("index_recall", "swept vec20", """
SELECT nprobe, round(avg(r), 6) AS recall, round(min(r), 6) AS worst FROM (
""" + " UNION ALL ".join(f"""
SELECT {n} AS nprobe, t.query_id, count(a.doc_id) / count(*) AS r FROM vec20 t
LEFT JOIN ({ranked('swept', 's', 20, f'place <= {n}')}) a ON a.query_id = t.query_id AND a.doc_id = t.doc_id
GROUP BY t.query_id""" for n in (8, 16, 24, 40, 56)) + ") GROUP BY nprobe")
_oracle("hybrid_bounded", "fused20", _FUSED.format("SELECT * FROM fused20"))
_oracle("hybrid_cells", "fused_near", _FUSED.format("SELECT * FROM fused_near"))
_cte("cosine_titles", "cosines docs", "SELECT c.*, title FROM cosines c JOIN docs USING (doc_id)")
_cte("lex_title", "bm25_docs", ranked("bm25_docs", "s", 20, "title < 'n'"))
_cte("vec_title", "cosine_titles", ranked("cosine_titles", "s", 20, "title < 'n'"))
_oracle("hybrid_title_filter", "lex_title vec_title", _FUSED.format(fused([("lex_title", 1), ("vec_title", 1)])))

# F. reranking -----------------------------------------------------------------
_oracle("rerank", "resorted", """
SELECT query_id, new_rank AS rank, doc_id, round(ce, 6) AS ce_score FROM resorted WHERE new_rank <= 10""")
_oracle("rerank_delta", "resorted", """
SELECT query_id, doc_id, retrieval_rank, retrieval_rank - new_rank AS rank_delta FROM resorted WHERE new_rank <= 10""")
_oracle("rerank_head_tail", "reranked25", "SELECT query_id, rank, doc_id FROM reranked25")

# G. funnel --------------------------------------------------------------------


def _funnel_rows(source: str, score: str) -> str:
    """The reranked shortlist of ten of a list of candidates."""
    return f"""
SELECT s.query_id, s.doc_id, s.ce, s.rank AS retrieval_rank, c.{score} AS score,
  row_number() OVER (PARTITION BY s.query_id ORDER BY s.ce DESC, s.rank)::int AS rank
FROM ({pair_scores(source, 10)}) s JOIN {source} c ON c.query_id = s.query_id AND c.doc_id = s.doc_id"""


_FINAL = """
SELECT query_id, rank, doc_id, round(score, 6) AS score, round(ce, 6) AS ce_score, retrieval_rank,
  retrieval_rank - rank AS rank_delta FROM ({}) WHERE rank <= 5"""
_cte("third", "fused20 qpairs dtoks qweights", _funnel_rows("fused20", "rrf_score"))
_oracle("funnel_hybrid", "third", _FINAL.format("SELECT * FROM third"))
_oracle("funnel_cells", "fused_near qpairs dtoks qweights", _FINAL.format(_funnel_rows("fused_near", "rrf_score")))
_cte("near_ids", "", """
SELECT doc_id FROM (
  SELECT doc_id, 2 * 6371008.7714 * asin(sqrt(least(1.0, pow(sin(radians(lat - 10) / 2), 2)
         + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(lon - 20) / 2), 2)))) AS m
  FROM (SELECT doc_id, (doc_id * 37 % 181 - 90)::DOUBLE AS lat, (doc_id * 71 % 361 - 180)::DOUBLE AS lon FROM documents))
WHERE m <= 6000000""")
_cte("lex_geo", "bm25_docs near_ids", ranked(
    "(SELECT * FROM bm25_docs SEMI JOIN near_ids USING (doc_id))", "s + (source = 'src3')::int", 20))
_cte("vec_geo", "cosines near_ids", ranked("(SELECT * FROM cosines SEMI JOIN near_ids USING (doc_id))", "s", 20))
_cte("fused_geo", "lex_geo vec_geo", fused([("lex_geo", 1), ("vec_geo", 1)]))
_oracle("funnel_geo", "fused_geo qpairs dtoks qweights", _FINAL.format(_funnel_rows("fused_geo", "rrf_score")))
_cte("lex_en", "bm25_docs", ranked("bm25_docs", "s", 20, "lang = 'en'"))
_oracle("funnel_lexical", "lex_en qpairs dtoks qweights", _FINAL.format(_funnel_rows("lex_en", "score")))
_oracle("funnel_neural", "vec20", """
SELECT query_id, rank, doc_id, round(score, 6) AS score, rank AS retrieval_rank, 0 AS rank_delta
FROM vec20 WHERE rank <= 5""")


def _stage(no: int, name: str, n_in: str, n_out: str, ids: str) -> str:
    return (f"SELECT query_id, {no} AS stage_no, '{name}' AS stage, {n_in}::bigint AS n_in, "
            f"{n_out}::bigint AS n_out, coalesce({ids}, '') AS top_ids FROM per_query")


_PER_QUERY = """
WITH per_query AS (
  SELECT a.query_id, coalesce(c, 0) AS c, coalesce(r, 0) AS r, c_ids, r_ids FROM asked a
  LEFT JOIN (SELECT query_id, count(*) AS c, string_agg(doc_id::varchar, '{sep}' ORDER BY rank) FILTER (rank <= 3) AS c_ids
             FROM {first} GROUP BY query_id) USING (query_id)
  LEFT JOIN (SELECT query_id, count(*) AS r, string_agg(doc_id::varchar, '{sep}' ORDER BY rank) FILTER (rank <= 3) AS r_ids
             FROM {third} GROUP BY query_id) USING (query_id))"""
_oracle("funnel_trace", "asked fused20 third", "SELECT * FROM (" + _PER_QUERY.format(sep=",", first="fused20", third="third")
        + " UNION ALL ".join([
            _stage(1, "1. retrieve (hybrid)", "20", "c", "c_ids"),
            _stage(2, "2. trim", "c", "least(c, 12)", "c_ids"),
            _stage(3, "3. rerank", "least(c, 10)", "r", "r_ids"),
            _stage(4, "4. final", "r", "least(r, 5)", "r_ids")]) + ")")
_oracle("funnel_trace_text", "asked lex20", """
SELECT query_id, stage_no, format('{:<22} {:>4} -> {:<4}  top: {}', stage, n_in, n_out, top_ids) AS line FROM ("""
        + _PER_QUERY.format(sep=", ", first="lex20", third="(SELECT * FROM lex20 WHERE rank <= 12)")
        + " UNION ALL ".join([
            _stage(1, "1. retrieve (lexical)", "20", "c", "c_ids"),
            _stage(2, "2. trim", "c", "least(c, 12)", "c_ids"),
            _stage(3, "3. rerank (skipped)", "least(c, 12)", "r", "r_ids"),
            _stage(4, "4. final", "r", "least(r, 5)", "r_ids")]) + ")")

# H. evaluation ----------------------------------------------------------------
_oracle("dcg", "", """
SELECT query_id, round(coalesce(sum(g) FILTER (l_linenumber <= 3), 0), 6) AS dcg_3, round(sum(g), 6) AS dcg_all FROM (
  SELECT l_orderkey AS query_id, l_linenumber,
         (pow(2, floor(l_quantity / 13)) - 1) / log2(l_linenumber + 1) AS g FROM lineitem) GROUP BY query_id""")
_oracle("ndcg", "lex100 qrels asked", rounded(
    metric_rows("lex100", ks=(5, 10, 100, None), rks=(), asked=_ASKED), "query_id, ",
    ["ndcg_5", "ndcg_10", "ndcg_100", "ndcg_all"]))
_oracle("recall", "lex100 qrels asked", rounded(
    metric_rows("lex100", ks=(), rks=(10, 100), relevant="label IN ('E', 'S')", asked=_ASKED), "query_id, ",
    ["recall_10", "recall_100"]))
_oracle("evaluate_query", "per_variant", rounded("SELECT * FROM per_variant", "variant, query_id, ", _M))
_oracle("evaluate_run", "vec100 qrels asked", means(metric_rows("vec100", asked=_ASKED), "", _M))
_oracle("evaluate_gain", "lex100 qrels", rounded(
    metric_rows("lex100", ks=(10,), rks=(), grade="gain"), "query_id, ", ["ndcg_10"]))
_oracle("judged_ranking", "fused100 qrels", """
SELECT f.query_id, f.rank, f.doc_id, coalesce(label, '—unjudged—') AS label FROM fused100 f
LEFT JOIN qrels q ON q.query_id = f.query_id AND q.doc_id = f.doc_id WHERE f.rank <= 10""")
_oracle("variant_comparison", "per_variant", means("SELECT * FROM per_variant", "variant", _M))
_cte("variant_means", "per_variant", means("SELECT * FROM per_variant", "variant", _M, digits=False))
_oracle("relative_to_baseline", "variant_means", """
SELECT variant, round((ndcg_10 / base - 1) * 100, 1) AS pct_vs_baseline
FROM variant_means, (SELECT ndcg_10 AS base FROM variant_means WHERE variant = 'lexical')""")
_oracle("recall_ceiling", "variant_means", """
SELECT round(max(recall_100), 6) AS ceiling, round(1 - max(recall_100), 6) AS never_retrieved FROM variant_means""")
_WEIGHTS = [(1, 0), (2, 1), (1, 1), (1, 2), (0, 1)]
_cte("weighted", "lex100 vec100", " UNION ALL ".join(
    f"SELECT '{a}:{b}' AS weights, query_id, rank, doc_id FROM ({fused([('lex100', a), ('vec100', b)])})"
    for a, b in _WEIGHTS))
_oracle("weight_sweep", "weighted qrels asked", means(metric_rows(
    "weighted", "weights", ks=(10,), rks=(),
    asked="SELECT weights, query_id FROM asked, (VALUES {}) v(weights)".format(
        ", ".join(f"('{a}:{b}')" for a, b in _WEIGHTS))), "weights", ["ndcg_10"]))
_DEPTHS = (5, 10, 25, 50)
_cte("by_depth", "fused100 scores50", " UNION ALL ".join(f"""
SELECT {d} AS depth, query_id, doc_id, row_number() OVER (
  PARTITION BY query_id ORDER BY (f.rank > {d})::int, CASE WHEN f.rank <= {d} THEN -ce END, f.rank) AS rank
FROM fused100 f LEFT JOIN (SELECT query_id, doc_id, ce FROM scores50) USING (query_id, doc_id)""" for d in _DEPTHS))
_oracle("depth_sweep", "by_depth qrels asked", means(metric_rows(
    "by_depth", "depth", ks=(10,), rks=(),
    asked="SELECT depth, query_id FROM asked, (VALUES {}) v(depth)".format(
        ", ".join(f"({d})" for d in _DEPTHS))), "depth", ["ndcg_10"]))
_oracle("rerank_invariant", "fused100", """
SELECT query_id, count(*) AS n_before, count(*) AS n_after, 0::bigint AS n_lost, 0::bigint AS n_gained
FROM fused100 GROUP BY query_id""")
_oracle("query_sample", "asked", """
SELECT query_id, query FROM asked ORDER BY md5('11:' || query_id::varchar), query_id LIMIT 30""")
_oracle("side_by_side", "lex100 vec100 docs", """
SELECT coalesce(l.query_id, v.query_id) AS query_id, coalesce(l.rank, v.rank) AS rank,
  l.doc_id AS left_doc_id, v.doc_id AS right_doc_id, ld.title AS left_title, vd.title AS right_title
FROM (SELECT * FROM lex100 WHERE rank <= 5) l
FULL JOIN (SELECT * FROM vec100 WHERE rank <= 5) v ON l.query_id = v.query_id AND l.rank = v.rank
LEFT JOIN docs ld ON ld.doc_id = l.doc_id LEFT JOIN docs vd ON vd.doc_id = v.doc_id""")
_cte("heavy", "lex100 vec100", fused([("lex100", 1), ("vec100", 2)]))
_oracle("rank_shift", "heavy fused100", """
SELECT h.query_id, h.doc_id, h.rank AS rank_after, f.rank AS rank_before, f.rank - h.rank AS moved
FROM heavy h LEFT JOIN fused100 f ON f.query_id = h.query_id AND f.doc_id = h.doc_id WHERE h.rank <= 10""")
_oracle("mode_disagreement", "lex100 vec100", """
SELECT query_id, count(l)::bigint AS n_left, count(v)::bigint AS n_right,
  count(CASE WHEN l IS NOT NULL AND v IS NOT NULL THEN 1 END)::bigint AS n_common,
  round(count(CASE WHEN l IS NOT NULL AND v IS NOT NULL THEN 1 END) / count(*), 6) AS jaccard
FROM (SELECT coalesce(a.query_id, b.query_id) AS query_id, a.doc_id AS l, b.doc_id AS v
      FROM (SELECT * FROM lex100 WHERE rank <= 10) a
      FULL JOIN (SELECT * FROM vec100 WHERE rank <= 10) b ON a.query_id = b.query_id AND a.doc_id = b.doc_id)
GROUP BY query_id""")
_oracle("expected_winner", "lex100 vec100 fused100 qrels", """
SELECT query_id, doc_id, 'lexical' AS expected, l AS rank_lexical, v AS rank_neural, h AS rank_hybrid, winner,
  coalesce(winner = 'lexical', false) AS as_expected
FROM (SELECT *, CASE WHEN least(l, v, h) IS NULL THEN NULL WHEN l = least(l, v, h) THEN 'lexical'
        WHEN v = least(l, v, h) THEN 'neural' ELSE 'hybrid' END AS winner
  FROM (SELECT p.*, a.rank AS l, b.rank AS v, c.rank AS h
    FROM (SELECT query_id, min(doc_id) AS doc_id FROM qrels WHERE label = 'E' GROUP BY query_id) p
    LEFT JOIN lex100 a ON a.query_id = p.query_id AND a.doc_id = p.doc_id
    LEFT JOIN vec100 b ON b.query_id = p.query_id AND b.doc_id = p.doc_id
    LEFT JOIN fused100 c ON c.query_id = p.query_id AND c.doc_id = p.doc_id))""")
