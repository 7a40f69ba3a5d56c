"""The registered query of each operator, with its production parameters, and SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeline.llm import (
    bpe,
    conversation_repair,
    exact_dedup,
    html_extract,
    language_id,
    minhash,
    mixing,
    quality_rules,
    simhash,
    substring_dedup,
    token_count,
    url_filter,
    whitening,
)

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

# Fixed values of the contract: verdict, host, path.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.judge(_table(spark, folder, "pages"), rules)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        "taken",
        "first_slot",
        "last_slot",
    )


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return token_count.token_counts(docs, public_tokenizers.path(TOKENIZER))


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(_table(spark, folder, "pages"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(_table(spark, folder, "documents"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "rule")


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.without_repeats(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair(_table(spark, folder, "conversations"))


def op13_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _sql_attribute(name: str) -> str:
    value = rf"""(?is)[\s"''/]{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return "concat(" + ", ".join(f"regexp_extract(tag, '{value}', {k})" for k in (1, 2, 3)) + ")"


def _sql_parts(url: str) -> str:
    """Host, path and query of a URL expression, as three SQL columns."""
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END"
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return rf"""
        coalesce(translate(regexp_extract({rest}, '^[^/?#]*'), {lower}), '') AS host,
        coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') AS path,
        coalesce(regexp_extract({rest}, '^[^?#]*(\?[^#]*)', 1), '') AS query"""


_SQL_ALIAS = "CASE WHEN host <> '' THEN host || CASE path WHEN '' THEN '/' ELSE path END || query END"

# a rule of each host and path, and the links between pages, as far as targets are written in full
ORACLE_OP2 = rf"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (
    VALUES {", ".join(map(str, URL_RULES))}),
split AS (SELECT page_id, url, html, {_sql_parts("url")} FROM pages),
u AS (SELECT *, {_SQL_ALIAS} AS alias FROM split),
tags AS (
    SELECT alias, unnest(regexp_extract_all(
        regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script|<style\b.*?</style', ' ', 'g'),
        '(?is)<(?:link|meta)\b[^>]*>')) AS tag
    FROM u),
targets AS (
    SELECT alias, replace(CASE
        WHEN regexp_matches(tag, '(?i)^<link\b')
            AND regexp_matches({_sql_attribute("rel")}, '(?i)(^|\s)canonical(\s|$)')
            THEN {_sql_attribute("href")}
        WHEN regexp_matches(tag, '(?i)^<meta\b')
            AND lower(trim({_sql_attribute("http-equiv")})) = 'refresh'
            THEN regexp_extract({_sql_attribute("content")},
                '(?is)^\s*[\d.]*\s*[;,]\s*url\s*=\s*[''"]?([^''"]*)', 1) END, '&amp;', '&') AS url
    FROM tags),
ends AS (SELECT alias AS src, {_sql_parts("url")} FROM targets WHERE url LIKE 'http%://%'),
edges AS (SELECT src, {_SQL_ALIAS} AS dst FROM ends),
both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reached AS (
    SELECT src AS node, src AS seen FROM both_ways
    UNION SELECT node, dst FROM reached JOIN both_ways ON src = seen),
nodes AS (SELECT node, seen, {_sql_parts("'http://' || seen")} FROM reached),
fitting AS (
    SELECT p.host, p.path, rule_host || rule_path AS rule, verdict,
        row_number() OVER (PARTITION BY p.host, p.path
            ORDER BY length(rule_host || rule_path) DESC, verdict) AS place
    FROM (SELECT host, path FROM u UNION SELECT host, path FROM nodes) p JOIN rules
        ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host))
            AND starts_with(p.path, rule_path)),
best AS (SELECT * FROM fitting WHERE place = 1),
groups AS (
    SELECT node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow'
        WHEN bool_or(verdict = 'block') THEN 'block' END AS decision
    FROM nodes LEFT JOIN best USING (host, path) GROUP BY node)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, decision, 'allow') AS verdict,
    node IS NOT NULL AS aliases
FROM u LEFT JOIN best USING (host, path) LEFT JOIN groups ON node = alias"""

ORACLE_OP3 = f"""
WITH d AS (
    SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
        CASE WHEN text IS NULL THEN '' ELSE sha256(text) END AS digest
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source),
w AS (
    SELECT *, CAST(CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight,
        CAST(2 * source_size AS DOUBLE) AS cap
    FROM s),
f AS (
    SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER ()
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w),
t AS (
    SELECT source, source_size, place,
        least(cap, weight * (SELECT level FROM f WHERE level <= cap / weight
            ORDER BY cap / weight, place LIMIT 1)) AS target
    FROM f),
q AS (
    SELECT *, least(CAST(round(target) AS BIGINT), 2 * source_size) AS words,
        (source_size + 1023) // 1024 AS blocks,
        sum(target) OVER (ORDER BY place) / sum(target) OVER () AS high
    FROM t),
u AS (
    SELECT *, coalesce(lag(high) OVER (ORDER BY place), 0) AS low,
        CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * blocks
            + (words % source_size + 1023) // 1024 END AS slots
    FROM q),
n AS (SELECT CAST(sum(slots) AS BIGINT) AS points FROM u),
draws AS (
    SELECT k, CAST(CAST(k AS DECIMAL(13, 0)) * 0.6180339887498948482045868 % 1 AS DOUBLE) AS point
    FROM (SELECT unnest(range(1, points + 1)) AS k FROM n)),
drawn AS (
    SELECT place, 2 * k AS slot
    FROM draws JOIN u ON low <= point AND point < high AND source_size > 0),
short AS (
    SELECT place, slots - count(slot) AS missing
    FROM u LEFT JOIN drawn USING (place) GROUP BY place, slots),
added AS (
    SELECT place, ((2 * k - 1) * points) // (2 * missing) * 2 + 1 AS slot
    FROM (SELECT place, missing, unnest(range(1, missing + 1)) AS k FROM short), n),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS rank
    FROM (FROM drawn UNION ALL FROM added)),
held AS (
    SELECT place, slot, (rank % blocks) * 1024 AS place_at, least(
        1024, source_size - (rank % blocks) * 1024,
        words - (rank // blocks) * source_size - (rank % blocks) * 1024) AS many
    FROM ranked JOIN u USING (place) WHERE rank < slots),
b AS (
    SELECT d.*, u.*, coalesce(sum(size) OVER (PARTITION BY place
        ORDER BY md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', digest)), doc_id, digest
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
    FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
seen AS (
    SELECT place, begin, min(slot) AS first_slot, max(slot) AS last_slot
    FROM b JOIN held USING (place)
    WHERE many > 0 AND size > 0 AND place_at < begin + size AND place_at + many > begin
    GROUP BY place, begin)
SELECT doc_id, size, source_size, round(target, 6) AS target,
    CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
        + greatest(0, least(begin + size, words % source_size) - begin) END AS BIGINT) AS taken,
    CASE WHEN size > 0 THEN first_slot END AS first_slot,
    CASE WHEN size > 0 THEN last_slot END AS last_slot
FROM b LEFT JOIN seen USING (place, begin)"""

ORACLE_OP9 = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents),
p AS (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM w),
h AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS passage FROM p),
repeated AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY passage) > 1),
covered AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM repeated),
each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM each ANTI JOIN covered USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)"""

ORACLE_OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_level_bpe": op1_byte_level_bpe,
        "op2_url_filter": op2_url_filter,
        "op3_mixing": op3_mixing,
        "op4_token_counts": op4_token_counts,
        "op5_simhash_near_dedup": op5_simhash_near_dedup,
        "op6_html_extraction": op6_html_extraction,
        "op7_language_id": op7_language_id,
        "op8_quality_rules": op8_quality_rules,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_minhash_near_dedup": op13_minhash_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": ORACLE_OP2,
        "op3_mixing": ORACLE_OP3,
        "op9_substring_dedup": ORACLE_OP9,
        "op10_exact_dedup": ORACLE_OP10,
    }
