"""The registered queries of this subpackage and the SQL of those that have any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rankforge.llm.debruijn import op13_substring_dedup
from rankforge.llm.langid import op7_language_id
from rankforge.llm.lm import op10_lm_scoring
from rankforge.llm.merkle import op11_merkle_manifest
from rankforge.llm.mixing import op2_source_mixing
from rankforge.llm.packing import op5_packing
from rankforge.llm.presence import op12_ranked_lexical_search
from rankforge.llm.quality import op4_quality_classifier
from rankforge.llm.rules import op6_quality_rules
from rankforge.llm.secret_scan import op8_secret_scan
from rankforge.llm.simhash import op9_simhash_near_dedup
from rankforge.llm.topk import op3_exact_top_k
from rankforge.llm.toxicity import op1_toxicity

QUERIES = (
    op1_toxicity, op2_source_mixing, op3_exact_top_k, op4_quality_classifier, op5_packing, op6_quality_rules,
    op7_language_id, op8_secret_scan, op9_simhash_near_dedup, op10_lm_scoring, op11_merkle_manifest,
    op12_ranked_lexical_search, op13_substring_dedup,
)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in QUERIES}
    found["pipeline"] = corpus_pipeline.run
    return found


def oracles() -> dict[str, str]:
    found = {
        "op3_exact_top_k": TOP_K, "op11_merkle_manifest": MANIFEST, "op12_ranked_lexical_search": LEXICAL,
        "op13_substring_dedup": SUBSTRINGS,
    }
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""

# CRC-32 by its polynomial, bit by bit: only its lowest bit is used.
MANIFEST = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source,
        concat_ws('', """ + ", ".join(
    f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars")) + r""") AS head, text,
        list_reduce(list_transform(range(0, length(CAST(doc_id AS VARCHAR))),
                lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i + 1]) AS BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, i: xor(x >> 1, 3988292384 * (x & 1))), CAST(4294967295 AS BIGINT)) AS crc
    FROM documents
), hashed AS (
    SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(
            octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS tampered
    FROM fields
), leaves AS (
    SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n FROM hashed
), up AS (
    SELECT tree, 0 AS level, pos AS idx, leaf AS digest, n FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
    FROM up WHERE n > 1 GROUP BY tree, level, n, idx // 3
), top AS (
    SELECT 0 AS level, tree AS idx, digest, count(*) OVER () AS n FROM up WHERE n = 1
    UNION ALL
    SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
    FROM top WHERE n > 1 GROUP BY level, n, idx // 3
), nodes AS (
    SELECT tree, level, idx, digest, n FROM up UNION ALL SELECT -1, level, idx, digest, n FROM top
), beside AS (
    SELECT a.tree, a.level, a.idx,
        coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
    FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
    WHERE a.n > 1 GROUP BY a.tree, a.level, a.idx
), fold AS (
    SELECT r, tree, 0 AS level, pos AS idx, coalesce(tampered, leaf) AS digest, '' AS proof FROM leaves
    UNION ALL
    SELECT f.r, f.tree, f.level + 1, f.idx // 3, sha256(b.l || f.digest || b.r), f.proof || b.l || b.r
    FROM fold f JOIN beside b ON f.tree = b.tree AND f.level = b.level AND f.idx = b.idx
), half AS (
    SELECT r, tree, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM fold GROUP BY r, tree
), rise AS (
    SELECT r, 0 AS level, tree AS idx, digest, proof FROM half
    UNION ALL
    SELECT f.r, f.level + 1, f.idx // 3, sha256(b.l || f.digest || b.r), f.proof || b.l || b.r
    FROM rise f JOIN beside b ON b.tree = -1 AND f.level = b.level AND f.idx = b.idx
), done AS (
    SELECT r, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM rise GROUP BY r
)
SELECT v.doc_id, v.leaf, s.digest AS subroot, t.digest AS root, sha256(d.proof) AS proof_sha256,
    d.digest AS folded_root, d.digest = t.digest AS verified
FROM leaves v JOIN done d ON v.r = d.r JOIN up s ON s.tree = v.tree AND s.n = 1 JOIN top t ON t.n = 1
"""

LEXICAL = r"""
WITH terms AS (
    SELECT rowid AS d, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), tf AS (
    SELECT d, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), lengths AS (
    SELECT d, sum(tf) AS n FROM tf GROUP BY d
), corpus AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, corpus GROUP BY term, docs
), asked AS (
    SELECT item_id, term, count(*) AS qtf FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)) GROUP BY ALL
), scored AS (
    SELECT item_id, doc_id, d, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (
        75 + CAST((25 * n * docs) // all_terms AS BIGINT))))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (d), corpus
    WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id, d
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
        doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""

SUBSTRINGS = r"""
WITH cut AS (
    SELECT row_number() OVER () AS r, doc_id,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT r, doc_id, p, array_to_string(words[p:p + 49], ' ') AS w
    FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM cut WHERE doc_id IS NOT NULL)
), first AS (
    SELECT w, min(doc_id) AS first FROM windows GROUP BY w
), gone AS (
    SELECT DISTINCT r, p + o AS p FROM (
        SELECT r, p FROM windows JOIN first USING (w) WHERE first < doc_id), (SELECT unnest(range(0, 50)) AS o)
), placed AS (
    SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM cut
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM placed ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (r)
"""
