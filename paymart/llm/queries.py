"""The registered queries of the operators: thin wrappers with production
parameters over whole tables, each with the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.llm import let_workers_import
from paymart.llm.collocations import mine_collocations
from paymart.llm.collocations import oracle_sql as collocation_sql
from paymart.llm.decontamination import judge_documents
from paymart.llm.language_id import identify_languages
from paymart.llm.lm_scoring import score_documents
from paymart.llm.near_dedup import near_groups
from paymart.llm.quality_classifier import classify_quality
from paymart.llm.quality_rules import judge_quality
from paymart.llm.source_mixing import mix_sources
from paymart.llm.source_mixing import oracle_sql as mixing_sql
from paymart.llm.substring_dedup import dedup_substrings
from paymart.llm.token_alignment import align_tokens
from paymart.llm.token_counts import count_tokens
from paymart.llm.topk_search import oracle_sql as topk_sql
from paymart.llm.topk_search import search
from paymart.llm.url_filter import judge_urls, rule_table
from paymart.llm.url_filter import oracle_sql as url_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")

def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")

def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))

def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", "p_good")

def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")

def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return (judge_documents(docs, _table(spark, sf_dir, "benchmark"))
            .select("doc_id", "contaminated", "items"))

def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return (classify_quality(docs, _table(spark, sf_dir, "labels"))
            .select("doc_id", "p_quality", "p_toxic", "p_good", "kept"))

def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs).select("doc_id", "n_tokens", "log_prob", "mean_log_prob")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("text", "lang")
    return mine_collocations(docs)


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors.where("vec_id % 50 = 0"), vectors)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_token_counts": op7_token_counts,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_source_mixing": op10_source_mixing,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_topk_search": op12_topk_search,
    "op13_token_alignment": op13_token_alignment,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op6_url_filter": url_sql(),
    "op10_source_mixing": mixing_sql(),
    "op11_phrase_collocations": collocation_sql(),
    "op12_topk_search": topk_sql(),
}
