"""The queries of this subpackage, each with the SQL that must agree where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import chat, fingerprint, line_dedup, mixing, near_dup, packing, quality
from hourloom.llm import spelling, substring_dedup, topk, url_filter, warc, whitening
from hourloom.llm.common import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rules of op9: host, path and action, as given.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), keep=("doc_id",))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS drop FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op3_line_dedup", LINE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


CHAT_SQL = r"""
WITH told AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn) AS turns
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), one_each AS (
  SELECT turns, min(conv_id) AS conv_id, count(*) AS n_snapshots FROM told GROUP BY turns
), begun AS (
  SELECT DISTINCT turns[1:n] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS n FROM one_each)
)
SELECT conv_id, len(turns)::BIGINT AS n_turns, n_snapshots,
  array_to_string(list_transform(turns, lambda x: '<|' || x.r || '|>' || chr(10) || x.t || chr(10) || '<|end|>' || chr(10)), '') AS rendered
FROM one_each WHERE turns NOT IN (SELECT turns FROM begun)
"""


@query("op4_chat_format", CHAT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(table(spark, sf_dir, "documents"))


@query("op8_near_dup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), threshold=85)


URL_SQL = r"""
WITH parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path,
  (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
  coalesce((SELECT arg_max(action, length(rule_host || rule_path)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parsed
"""


@query("op9_url_filter", URL_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


TOP_SQL = r"""
WITH usable AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.place <> c.place AND len(q.v) = len(c.v)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""


@query("op10_top_k", TOP_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


WARC_SQL = r"""
WITH paid AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), ranked AS (
  SELECT page_id, strlen(payload) AS payload_bytes, unhex(sha1(payload))::BIT::VARCHAR AS bits,
    row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS place,
    max(page_id) OVER (PARTITION BY payload) AS head
  FROM paid
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5),
    lambda b: substr(bits, 5 * k + b + 1, 1)::INTEGER * (16 // (1 << b))))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN head END AS refers_to
FROM ranked
"""


@query("op11_warc", WARC_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The stages live at the top of the repository; they import this subpackage.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
