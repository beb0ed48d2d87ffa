"""The thin queries over whole tables, and the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quoteflow.llm import (
    benchmarks,
    chat,
    codes,
    licenses,
    near,
    packing,
    quality,
    resampling,
    secrets,
    sharding,
    simhash,
    substrings,
    urls,
)
from quoteflow.llm.common import table
from quoteflow.llm.sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = [f.name for f in quality.FIELDS]
    return quality.assess(docs).select("doc_id", *names)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.cut(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.join(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return benchmarks.score(docs, table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=16)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.examples(rows.unionAll(control)))


def op9_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer or default_tokenizer())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.quantize(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_secret_scan": op4_secret_scan,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_sharding": op6_sharding,
    "op7_chat_format": op7_chat_format,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_url_filter": op10_url_filter,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_simhash": op12_simhash,
    "op13_vector_codes": op13_vector_codes,
}
