"""The opN_ queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import benchmark_decontamination, hnsw, html_extraction, language_id, mixing, pii, simhash_dedup, substring_dedup, token_store, url_filter
from lodestone.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES["op2_substring_dedup"] = op2_substring_dedup
# words: RE2 has the same class; windows of 35 words compared as text
ORACLES["op2_substring_dedup"] = r"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 34, 0) + 1)) AS i FROM t
), hashed AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM win
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM hashed) WHERE c > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM rep
), dead AS (
  SELECT doc_id, list(k) AS ks, count(*) AS n FROM gone GROUP BY doc_id
), parsed AS (
  SELECT t.doc_id, w, coalesce(n, 0) AS n,
         list_filter(range(1, len(w) + 1), lambda k: NOT coalesce(list_contains(ks, k), false)) AS keep
  FROM t LEFT JOIN dead USING (doc_id)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(keep, lambda k: w[k]), ' '), '')) AS kept_sha256
FROM parsed
"""


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


QUERIES["op10_source_mixing"] = op10_source_mixing
# sources of up to 2**18 words are one shard, so a source's quota is its only stream's; several shards have a test
ORACLES["op10_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o, md5(coalesce(text, '')) AS tie FROM documents
), b AS (SELECT CAST(16 AS BIGINT) AS block, CAST(sum(size) AS BIGINT) AS total FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS sz, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM d GROUP BY source
), g AS (
  SELECT s.*, total, CAST(greatest(ceil(sz / greatest(ceil(sz / block), 1)), 1) AS BIGINT) AS per, CAST(sz AS DOUBLE) * 3 AS cap FROM s, b
), l AS (
  SELECT *, CAST(ceil(sz / per) AS BIGINT) AS n,
         (total - coalesce(sum(cap) OVER r, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER r, 0.0)) AS level
  FROM g WINDOW r AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (SELECT arg_min(level, cap / w) AS free FROM l WHERE NOT (level * w >= cap)
), t AS (
  SELECT l.*, CASE WHEN level * w >= cap THEN cap ELSE w * free END AS target FROM l, f
), v AS (
  SELECT *, CASE WHEN sz > 0 THEN target * n / sz ELSE 0.0 END AS vote FROM t
), seats AS (
  SELECT source, row_number() OVER (ORDER BY vote / (2 * k - 1) DESC, source NULLS LAST, k) AS r FROM (SELECT source, vote, unnest(range(1, 3 * n + 2)) AS k FROM v WHERE vote > 0)
), q AS (
  SELECT v.source, least(count(seats.r), 3 * any_value(v.n)) AS q FROM v LEFT JOIN seats
    ON v.source IS NOT DISTINCT FROM seats.source AND seats.r <= (SELECT round(sum(vote)) FROM v) GROUP BY v.source
), x AS (
  SELECT d.*, v.sz, v.target, v.per, v.n, v.n // 2 AS u, q.q,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
  FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, sz AS source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE
    ((((a + size) // per) * q + u) // n) * per + ((a + size) % per) * (((((a + size) // per) + 1) * q + u) // n - (((a + size) // per) * q + u) // n)
    - ((((a // per) * q + u) // n) * per + (a % per) * (((a // per + 1) * q + u) // n - ((a // per) * q + u) // n)) END AS BIGINT) AS taken
FROM x
"""


def tokenizer_path() -> str:
    """The vocabulary file of the op4 query; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_store(_documents(spark, sf_dir), tokenizer_path())


QUERIES["op4_token_store"] = op4_token_store


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_components(_documents(spark, sf_dir))


QUERIES["op5_simhash_dedup"] = op5_simhash_dedup


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.identify(docs, language_id.fit(docs))


QUERIES["op8_language_id"] = op8_language_id


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_decontamination.report(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES["op6_benchmark_decontamination"] = op6_benchmark_decontamination


def op1_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hnsw.neighbours(vectors, F.col("vec_id") % 20 == 0)


QUERIES["op1_hnsw_search"] = op1_hnsw_search


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(_pages(spark, sf_dir))


QUERIES["op7_html_extraction"] = op7_html_extraction
# for pages that mark their article up as one element, as the tables' pages do
ORACLES["op7_html_extraction"] = r"""
WITH b AS (
  SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>'),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM pages
), t AS (SELECT page_id, url, coalesce(array_to_string(l, chr(10)), '') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_pages(spark, sf_dir))


QUERIES["op9_url_filter"] = op9_url_filter


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_documents(spark, sf_dir))


QUERIES["op3_pii"] = op3_pii
