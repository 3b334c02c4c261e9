"""The operators applied to whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.llm import (
    decontamination,
    near_duplicates,
    nearest_neighbours,
    packing,
    personal_data,
    ranked_search,
    secret_scan,
    sequence_files,
    sharding,
    toxicity,
    url_filters,
    vector_codes,
    warc_revisits,
)
from arrearscope.llm.common import table

RULES = [
    url_filters.Rule("allow", "org", "/"),
    url_filters.Rule("block", "example.org", "/es/"),
    url_filters.Rule("block", "example.org", "/en/1"),
    url_filters.Rule("allow", "com", "/fr/"),
    url_filters.Rule("block", "com", "/de/"),
]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, table(spark, folder, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "toxic_ll", "ordinary_ll", "whole", "passage", "phrase")


def op2_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc_revisits.captures_of_pages(table(spark, folder, "pages").select("page_id", "url", "html"))
    return warc_revisits.resolve_revisits(captures).withColumn("headers", warc_revisits.headers_text(F.col("headers")))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filters.judge_urls(spark, pages, RULES).drop("url")


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.link_documents(table(spark, folder, "documents"))


def op6_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours.search_nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.scan_personal_data(table(spark, folder, "documents"))


def op10_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search_ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op13_token_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return sequence_files.tokenised_documents(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_secrets": op3_secrets,
    "op4_url_filter": op4_url_filter,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_minimax_shards": op6_minimax_shards,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_decontaminate": op8_decontaminate,
    "op9_personal_data": op9_personal_data,
    "op10_pack_sequences": op10_pack_sequences,
    "op11_ranked_search": op11_ranked_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_sequences": op13_token_sequences,
}

_PERMITTED = ", ".join(f"'{name}'" for name in warc_revisits.PERMITTED)

SQL = {
    "op11_ranked_search": ranked_search.sql(),
    "op12_vector_codes": vector_codes.sql(),
    "op2_warc_revisits": f"""
WITH bare AS (
 SELECT page_id, url, '"' || md5(html) || '"' AS tag,
   regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS bare FROM pages),
parts AS (
 SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www[0-9]*\\.|:(80|443)$', '') AS host,
   regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
   array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\\?(.*)$', 1), '&'),
     lambda p: p <> '' AND NOT regexp_matches(p, '{warc_revisits.TRACKING}'))), '&') AS query FROM bare),
named AS (
 SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical FROM parts),
captures AS (
 SELECT page_id * 4 AS record_id, page_id * 100 AS t, 'response' AS kind, tag, url, canonical,
   [('cache-control', 'max-age=60'), ('content-type', 'text/html'), ('server', 'one')] AS heads FROM named WHERE NOT ends_with(url, '#top')
 UNION ALL SELECT page_id * 4 + 1, page_id * 100 + 10, 'revisit', tag, url, canonical,
   [('cache-control', 'max-age=600'), ('content-length', '0'), ('server', 'two')] FROM named
 UNION ALL SELECT page_id * 4 + 2, page_id * 100 + 20, 'revisit', tag, url, canonical,
   [('vary', 'accept')] FROM named WHERE contains(url, '.html')
 UNION ALL SELECT page_id * 4 + 3, page_id * 100 + 30, 'revisit', '"changed"', url, canonical,
   [('cache-control', 'no-store')] FROM named WHERE contains(url, 'utm_source')),
paired AS (
 SELECT v.record_id, v.url, v.canonical, v.t, v.tag, r.record_id AS refers_to, r.tag AS r_tag, r.t AS r_t,
   row_number() OVER (PARTITION BY v.record_id ORDER BY r.t DESC, r.record_id DESC) AS nth
 FROM captures v LEFT JOIN captures r ON r.kind = 'response' AND r.canonical = v.canonical AND (r.t, r.record_id) < (v.t, v.record_id)
 WHERE v.kind = 'revisit'),
judged AS (
 SELECT *, CASE WHEN refers_to IS NULL THEN 'missing' WHEN tag IS NULL OR r_tag IS NULL THEN 'unverified'
   WHEN tag = r_tag THEN 'resolved' ELSE 'mismatch' END AS state FROM paired WHERE nth = 1),
flat AS (
 SELECT record_id, h[1] AS name, h[2] AS value FROM (
   SELECT record_id, unnest(list_transform(heads, lambda h: [h[1], h[2]])) AS h FROM captures)
 UNION ALL SELECT record_id, 'date', CAST(t AS VARCHAR) FROM captures),
updates AS (
 SELECT record_id, name, value FROM flat WHERE name IN ({_PERMITTED})),
merged AS (
 SELECT j.record_id, f.name, f.value FROM judged j JOIN flat f ON f.record_id = j.refers_to AND j.state = 'resolved'
 WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.record_id = j.record_id AND u.name = f.name)
 UNION ALL SELECT j.record_id, u.name, u.value FROM judged j JOIN updates u ON u.record_id = j.record_id AND j.state = 'resolved'),
texts AS (
 SELECT record_id, string_agg(name || ': ' || value, chr(10) ORDER BY name) AS headers FROM merged GROUP BY record_id)
SELECT j.record_id, j.url, j.canonical, j.refers_to, j.state, texts.headers
FROM judged j LEFT JOIN texts ON texts.record_id = j.record_id""",
    "op4_url_filter": """
WITH rest AS (
 SELECT page_id, CASE WHEN position('://' IN url) > 0
   THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
 SELECT page_id,
   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, h, p) AS (VALUES """ + ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES) + """),
fits AS (
 SELECT page_id, h || p AS rule, verdict,
   row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC) AS nth
 FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON fits.page_id = parts.page_id AND nth = 1""",
}
