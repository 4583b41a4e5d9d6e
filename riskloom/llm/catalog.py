"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import chat, decontaminate, divergence, minhash, packing, pii, quality, resample, secrets, sharding, suffix, tokens, warc
from riskloom.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.report(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, packed into sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("text_key", "host", "lines")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back from them."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat elsewhere, removed."""
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document leaks."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source of a language differs from the others, and in which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and place in the draw of every document, with the benchmark as target."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what its formatted text says when read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)], "conv_id long, turn long, role string, text string")
    return chat.report(rows.unionByName(more))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_minhash": op2_minhash,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_line_frequency": op5_line_frequency,
    "op6_warc": op6_warc,
    "op7_suffix_array": op7_suffix_array,
    "op8_secrets": op8_secrets,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_divergence": op11_divergence,
    "op12_resampling": op12_resampling,
    "op13_chat": op13_chat,
}
