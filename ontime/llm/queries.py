"""The registered queries of this folder: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import bpe, classifier, html_extract, lm, packing, rules, simhash, suffix, token_align, url_lists, vafile, whiten
from ontime.llm import exact_dedup as exact
from ontime.llm.common import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return register


@query("op6_exact_dedup", r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents
), r AS (
  SELECT doc_id, content,
    first_value(doc_id) OVER (PARTITION BY content ORDER BY length(body) DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size,
    row_number() OVER (PARTITION BY content ORDER BY length(body) DESC, doc_id NULLS LAST) = 1 AS kept
  FROM t
)
SELECT doc_id, keep_id, group_size, kept, sha256(content) AS text_sha256 FROM r""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op9_byte_level_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op7_suffix_array_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_spans(table(spark, sf_dir, "documents"))


@query("op8_katz_backoff")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


#: Two made-up lists with histories that hang on a hash of each key: the tables hold no lists.
_CHANGES = """
  SELECT list_name, verdict, key, CASE WHEN k % 2 = 0 THEN 'add' ELSE 'remove' END AS action, {day}
  FROM (SELECT list_name, verdict, key, k, md5(concat(list_name, key, k)) AS digest
    FROM (SELECT 'hosts' AS list_name, 'block' AS verdict, host AS key FROM hosts WHERE substr(md5(host), 1, 1) < '6'
      UNION ALL SELECT 'domains', 'block', domain FROM (SELECT DISTINCT domain FROM hosts) AS d WHERE substr(md5(domain), 1, 1) < '5'
      UNION ALL SELECT 'partners', 'allow', host FROM hosts WHERE substr(md5(concat(host, '+')), 1, 1) < '4') AS keys
    CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) AS times) AS dated"""


@query("op3_url_filters", r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * ((page_id * 7919) % 730) AS fetched_at,
    lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages
), hosts AS (
  SELECT DISTINCT host, regexp_replace(host, '^[^.]*\.', '') AS domain FROM captures WHERE host <> ''
), changes AS (""" + _CHANGES.format(day="TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (('0x' || substr(digest, 1, 6))::BIGINT % 730) AS moment") + r"""
), moments AS (
  SELECT list_name, verdict, key, moment, max(action) AS action FROM changes GROUP BY ALL
), states AS (
  SELECT *, lead(moment) OVER (PARTITION BY list_name, verdict, key ORDER BY moment) AS until FROM moments
), active AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY length(key) DESC, verdict, list_name) AS place, verdict, list_name, key, moment
  FROM captures JOIN states ON (host = key OR ends_with(host, '.' || key)) AND moment <= fetched_at AND (until IS NULL OR fetched_at < until)
  WHERE action = 'add'
)
SELECT c.page_id, c.url, c.fetched_at, coalesce(a.verdict <> 'block', true) AS kept, a.list_name, a.key AS list_key, a.moment AS listed_since
FROM captures c LEFT JOIN active a ON a.page_id = c.page_id AND a.place = 1""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr("timestamp '2024-01-01' + make_dt_interval(int((page_id * 7919) % 730))"))
    hosts = captures.select(url_lists.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    hosts = hosts.withColumn("domain", F.regexp_replace("host", r"^[^.]*\.", ""))
    lists = [
        hosts.where(F.substring(F.md5("host"), 1, 1) < "6").select(F.lit("hosts").alias("list_name"), F.lit("block").alias("verdict"), F.col("host").alias("key")),
        hosts.select("domain").distinct().where(F.substring(F.md5("domain"), 1, 1) < "5").select(F.lit("domains"), F.lit("block"), "domain"),
        hosts.where(F.substring(F.md5(F.concat("host", F.lit("+"))), 1, 1) < "4").select(F.lit("partners"), F.lit("allow"), "host"),
    ]
    dated = lists[0].union(lists[1]).union(lists[2]).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    day = F.conv(F.substring(F.md5(F.concat("list_name", "key", F.col("k").cast("string"))), 1, 6), 16, 10).cast("int") % 730
    changes = dated.select("list_name", "verdict", "key", F.when(F.col("k") % 2 == 0, "add").otherwise("remove").alias("action"), day.alias("day"))
    changes = changes.withColumn("at", F.expr("timestamp '2024-01-01' + make_dt_interval(day)")).drop("day")
    return url_lists.verdicts(captures, changes)


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"))


@query("op12_exact_top_k", r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, place::INT AS rank, vec_id, score FROM r WHERE place <= 5""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
