"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm.common import fresh_path, id_remainder, table
from tripgrain.llm.decontaminate import find_leaks
from tripgrain.llm.filter_audit import audit_filters
from tripgrain.llm.html_text import extract_text
from tripgrain.llm.language_model import score_texts
from tripgrain.llm.oracle import ORACLE as WHOLE_SQL
from tripgrain.llm.packing import pack_documents
from tripgrain.llm.quality_model import fit_nearest, score_quality
from tripgrain.llm.quality_rules import judge_quality
from tripgrain.llm.resampling import resample
from tripgrain.llm.sharding import shard_rows
from tripgrain.llm.simhash import near_copies, print_text
from tripgrain.llm.token_store import read_tokens, write_tokens
from tripgrain.llm.toxicity import fit_toxicity, score_toxicity
from tripgrain.llm.url_rules import judge_urls, rules_frame

# Fixed by the contract.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_url_rules(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    return judge_urls(pages, rules_frame(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer; the files belong to a package that every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_store(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    write_tokens(table(spark, d, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    judged = judge_quality(table(spark, d, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    pieces = pack_documents(table(spark, d, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op6_quality_model(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").where(id_remainder(F.col("doc_id"), 4) != 2)
    scored = score_quality(docs, fit_nearest(docs, labels))
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").where(id_remainder(F.col("doc_id"), 3) != 1)
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op8_language_model(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = score_texts(docs, id_remainder(F.col("doc_id"), 5) != 1)
    return scored.withColumn("held_out", ~F.col("in_training")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_html_text(spark: SparkSession, d: str) -> DataFrame:
    return extract_text(table(spark, d, "pages")).select("page_id", "url", "text", "n_chars")


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, d)


def op10_simhash(spark: SparkSession, d: str) -> DataFrame:
    copies = near_copies(table(spark, d, "documents"))
    return copies.select("doc_id", print_text(F.col("fp")).alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return audit_filters(docs, table(spark, d, "labels"), {"good_lost": "quality", "toxic_lost": "toxic"})


def op12_sharding(spark: SparkSession, d: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    size, checksum = F.octet_length(body).cast("long") + 1, F.crc32(body.cast("binary"))
    docs = table(spark, d, "documents").select("doc_id", size.alias("size"), checksum.alias("text_crc32"))
    return shard_rows(docs).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op13_resampling(spark: SparkSession, d: str) -> DataFrame:
    drawn = resample(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_url_rules": op1_url_rules,
    "op2_token_store": op2_token_store,
    "op3_quality_rules": op3_quality_rules,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_quality_model": op6_quality_model,
    "op7_toxicity": op7_toxicity,
    "op8_language_model": op8_language_model,
    "op9_html_text": op9_html_text,
    "op10_simhash": op10_simhash,
    "op11_filter_audit": op11_filter_audit,
    "op12_sharding": op12_sharding,
    "op13_resampling": op13_resampling,
    "pipeline": pipeline,
}

# What DuckDB can say in SQL; the others are tested against brute force in tests/llm.
ORACLE = {
    "op1_url_rules": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), rules(rule_host, rule_path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), fits AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)""",
    **WHOLE_SQL,
}
