"""The numbered queries: thin contracts over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.llm import (
    alignment,
    hard_negatives,
    language,
    licenses,
    minhash,
    packing,
    pieces,
    quality,
    secret_scan,
    spotsigs,
    suffix_tree,
    vector_dedup,
    warc,
)
from quarterline.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f

    return add


@query("op1_suffix_tree")
def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), stratum=F.col("lang"))


@query("op3_revisits")
def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = warc.captures(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    entries = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return warc.with_bodies(warc.resolve(log), log).select(
        "record_id", "address", "captured", "response_id", "verdict", F.array_join(entries, ";").alias("headers"), F.sha2("body", 256).alias("body_sha256"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


@query("op5_minhash")
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


@query("op6_pieces")
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")).drop("ids")


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("forms", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind, *_ in secret_scan.FORMS], F.sha2(secret_scan.listed(F.col("forms")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


@query("op8_licenses")
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.size("found").cast("long").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct("found.license")), ",").alias("licenses"),
        F.array_max("found.containment").alias("best_containment"),
        F.array_join(F.transform("found", lambda m: F.concat_ws(":", m["license"], m["first_word"].cast("string"), m["end_word"].cast("string"))), ",").alias("matches"))


@query("op9_spotsigs")
def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_edits(documents(spark, sf_dir))


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op11_vectors")
def op11_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.linked(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_negatives")
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label=moved)


ORACLES["op3_revisits"] = r"""
WITH shaped AS (
  SELECT page_id p, html, url, '<!-- 2 -->' || substr(html, 1, 64) AS html2,
    regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), '^www\.|:(80|443)$', '', 'g') AS host,
    regexp_replace(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref)(=|$)'))) AS query,
    60 * page_id AS start, 'day ' || CAST(60 * page_id // 86400 AS VARCHAR) AS day1, 'day ' || CAST((60 * page_id + 864000) // 86400 AS VARCHAR) AS day2
  FROM pages),
addressed AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || '?' || array_to_string(query, '&') END AS address,
    '"' || substr(md5(html), 1, 16) || '"' AS tag1, '"' || substr(md5(html2), 1, 16) || '"' AS tag2 FROM shaped),
responses AS (
  SELECT 8 * p AS response_id, address, start AS at, tag1 AS tag, day1 AS modified, html FROM addressed WHERE html IS NOT NULL
  UNION ALL SELECT 8 * p + 1, address, start + 864000, tag2, day2, html2 FROM addressed WHERE html IS NOT NULL AND p % 2 = 0),
revisits AS (
  SELECT 8 * p + 3 AS record_id, address, start - 1 AS captured, tag1 AS sent, day1 AS modified FROM addressed WHERE p % 5 = 0
  UNION ALL SELECT 8 * p + 4, address, start + 86400 * (1 + p % 9),
    CASE WHEN p % 11 = 0 THEN '"other"' WHEN p % 7 = 0 THEN NULL WHEN p % 3 = 0 THEN 'W/' || tag1 ELSE tag1 END, day1 FROM addressed
  UNION ALL SELECT 8 * p + 5, address, start + 864000, tag1, day1 FROM addressed WHERE p % 2 = 0
  UNION ALL SELECT 8 * p + 6, address, start + 25 * 86400, CASE WHEN p % 5 = 0 THEN NULL WHEN p % 2 = 0 AND p % 7 <> 0 THEN tag2 ELSE tag1 END,
    CASE WHEN p % 5 <> 0 THEN day1 END FROM addressed WHERE p % 3 = 0),
ranked AS (
  SELECT v.*, r.response_id, r.tag, r.modified AS r_modified, r.html, r.at,
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.at DESC, r.response_id DESC) AS n
  FROM revisits v LEFT JOIN responses r ON r.address = v.address AND r.at < v.captured),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'unmatched'
    WHEN sent IS NOT NULL AND tag IS NOT NULL THEN CASE WHEN regexp_replace(sent, '^W/', '') = tag THEN 'resolved' ELSE 'changed' END
    WHEN modified IS NULL OR r_modified IS NULL THEN 'unproven' WHEN modified = r_modified THEN 'resolved' ELSE 'changed' END AS verdict
  FROM ranked WHERE n = 1)
SELECT record_id, address, captured, response_id, verdict,
  CASE WHEN verdict = 'resolved' THEN 'content-type=text/html;date=' || captured || ';etag=' || coalesce(sent, tag) || ';last-modified=' || r_modified END AS headers,
  CASE WHEN verdict = 'resolved' THEN sha256(html) END AS body_sha256
FROM judged
"""
