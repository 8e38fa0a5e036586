"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonehive.llm import decontam, html_main, langid, merkle, mixing, near_text, near_vec, pii, quality, sentences


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fixity_report(_table(spark, sf_dir, "pages"))


def op2_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vec.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op5_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), languages=None)


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_main(_table(spark, sf_dir, "pages"))


def op7_quality_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.remove_repeated_spans(_table(spark, sf_dir, "documents"), window=sentences.WINDOW)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_merkle_fixity": op1_warc_merkle_fixity,
        "op2_soft_membership_mixing": op2_soft_membership_mixing,
        "op3_minhash_near_dedup": op3_minhash_near_dedup,
        "op4_embedding_near_dedup": op4_embedding_near_dedup,
        "op5_kneser_ney_langid": op5_kneser_ney_langid,
        "op6_html_main_text": op6_html_main_text,
        "op7_quality_empirical_bayes": op7_quality_empirical_bayes,
        "op8_pii": op8_pii,
        "op9_benchmark_decontamination": op9_benchmark_decontamination,
        "op10_substring_dedup": op10_substring_dedup,
    }


#: Records as they are written, their digests, and the rows where the two replicas differ.
OP1_SQL = """
WITH worn AS (
  SELECT page_id, url, html,
         CASE WHEN page_id % 97 = 3 THEN 'x' || substring(html, 2)
              WHEN page_id % 97 = 50 THEN substring(html, 1, CAST(floor(length(html) / 2) AS INTEGER))
              ELSE html END AS worn
  FROM pages
), records AS (
  SELECT page_id,
         chr(13) || chr(10) AS eol,
         'WARC/1.0' || eol || 'WARC-Type: resource' || eol || 'WARC-Target-URI: ' || coalesce(url, '') || eol
           || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), 'none') || '>' || eol
           || 'Content-Type: text/html' || eol || 'Content-Length: ' AS head,
         coalesce(html, '') AS a, coalesce(worn, '') AS b
  FROM worn
), digests AS (
  SELECT page_id,
         sha256(head || CAST(strlen(a) AS VARCHAR) || eol || eol || a || eol || eol) AS expected,
         CASE WHEN coalesce(page_id % 97 = 77, FALSE) THEN NULL
              ELSE sha256(head || CAST(strlen(b) AS VARCHAR) || eol || eol || b || eol || eol) END AS found
  FROM records
)
SELECT page_id, CASE WHEN found IS NULL THEN 'missing' ELSE 'altered' END AS status, expected, found, count(*) AS times
FROM digests WHERE found IS DISTINCT FROM expected GROUP BY page_id, expected, found
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of distinct texts that share a shingle, and the closure of their links.
OP3_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), pairs AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY a.rid, b.rid
), links AS (
  SELECT x, y FROM pairs JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * k >= 85 * (a.n + b.n - k)
), reach AS (
  SELECT rid AS a, rid AS b FROM d
  UNION
  SELECT reach.a, links.y FROM reach JOIN links ON links.x = reach.b
), least AS (
  SELECT a, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.rid = reach.b GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id IS NOT DISTINCT FROM d.doc_id AS kept
FROM d LEFT JOIN n USING (rid) JOIN least ON least.a = d.rid
"""

#: Windows of the items, joined with the windows of the documents of the same lengths.
OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
), hit AS (
  SELECT rid, i, k, item_id FROM dw JOIN bw USING (k, win)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


#: The base patterns as the contract has them, each kind's test, and the words near each span.
_PII_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 OR TRY_CAST(x AS HUGEINT) > 255)) = 0"),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        "len(g) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, len(g) + 1), lambda i: CASE WHEN (len(g) - i) % 2 = 0 THEN CAST(g[i] AS INT) WHEN CAST(g[i] AS INT) > 4 THEN 2 * CAST(g[i] AS INT) - 9 ELSE 2 * CAST(g[i] AS INT) END)) % 10 = 0",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(g) BETWEEN 10 AND 15"),
    "iban": (
        rf"\b{pii.IBAN_FORM}\b",
        "len(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substring(replace(m, ' ', ''), 5) || substring(replace(m, ' ', ''), 1, 4), ''), lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda a, v: CASE WHEN v > 9 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) = 1",
    ),
}


def _op8_sql() -> str:
    found = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, '{name}' AS name, text, s, m, {pii.BASE_SCORE[name]} AS base, '{pii.CONTEXT[name][0]}' AS good, '{pii.CONTEXT[name][1]}' AS bad "
        f"FROM (SELECT rid, text, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS g, "
        f"list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s "
        f"FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT rid, text, regexp_extract_all(text, '{pattern}') AS ms, regexp_split_to_array(text, '{pattern}') AS ps FROM d))) WHERE {valid}"
        for k, (name, (pattern, valid)) in enumerate(_PII_KINDS.items())
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({found}),
z AS (
  SELECT *, name || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(m) AS BIGINT) AS span,
         lower(substring(text, CAST(greatest(s - {pii.NEAR}, 0) + 1 AS BIGINT), CAST(least(s, {pii.NEAR}) AS BIGINT)) || ' ' || substring(text, CAST(s + length(m) + 1 AS BIGINT), {pii.NEAR})) AS near
  FROM f
), scored AS (
  SELECT *, round(least(base + CASE WHEN regexp_matches(near, '(^|[^\p{{L}}])(?:' || good || ')([^\p{{L}}]|$)') THEN 0.1 ELSE 0.0 END
                              - CASE WHEN regexp_matches(near, '(^|[^\p{{L}}])(?:' || bad || ')([^\p{{L}}]|$)') THEN 0.3 ELSE 0.0 END, 1.0), 2) AS score FROM z
), g AS (
  SELECT rid, {", ".join(f"count(*) FILTER (WHERE name = '{n}') AS n_{n}" for n in _PII_KINDS)},
         string_agg(span, ',' ORDER BY s, kind) AS spans, string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE name <> 'iban') AS base_spans,
         string_agg(CAST(CAST(score AS DOUBLE) AS VARCHAR), ',' ORDER BY s, kind) AS scores
  FROM scored GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in _PII_KINDS)}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g USING (rid)
"""


#: The exact cosine of all pairs, and the closure of their links.
OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), u AS (
  SELECT rid, x, sqrt(list_sum(list_transform(x, lambda a: a * a))) AS n FROM v
  WHERE len(x) > 0 AND len(list_filter(x, lambda a: a IS NULL OR NOT isfinite(a))) = 0
), links AS (
  SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.rid <> b.rid AND len(a.x) = len(b.x) AND a.n > 0 AND b.n > 0
  WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.9
), reach AS (
  SELECT rid AS a, rid AS b FROM v
  UNION
  SELECT reach.a, links.y FROM reach JOIN links ON links.x = reach.b
), least AS (
  SELECT a, min(e.vec_id) AS component_id FROM reach JOIN v e ON e.rid = reach.b GROUP BY a
)
SELECT v.vec_id, coalesce(k, 0) AS n_links, component_id, component_id IS NOT DISTINCT FROM v.vec_id AS kept
FROM v JOIN least ON least.a = v.rid LEFT JOIN (SELECT x, count(*) AS k FROM links GROUP BY x) c ON c.x = v.rid
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_embedding_near_dedup": OP4_SQL, "op8_pii": _op8_sql(), "op1_warc_merkle_fixity": OP1_SQL, "op3_minhash_near_dedup": OP3_SQL, "op9_benchmark_decontamination": OP9_SQL}
