"""The operators bound to the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlark.llm import (
    alignment, chat, extraction, fingerprints, mixing, ngram_join, packing, quality, sharding, substrings, toxicity,
    vector_codes, warc,
)
from medlark.sources.readers import read_parquet

SHARDS = 24

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{d}/{name}.parquet")


def tokenizer_path(name: str = packing.TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sharding")
def op1_sharding(spark: SparkSession, d: str) -> DataFrame:
    dealt = sharding.interleave(_table(spark, d, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "source")


@query("op2_packing")
def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents"), tokenizer_path())


@query("op3_warc", warc.WARC_SQL)
def op3_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, d, "pages"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, d, "documents"), _table(spark, d, "labels"))


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    good = _table(spark, d, "labels").where("quality = 1")
    return quality.quality_rules(_table(spark, d, "documents"), good).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio")


@query("op6_ngram_join", ngram_join.JOIN_SQL)
def op6_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.join_components(_table(spark, d, "documents"))


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.likeness_and_neighbours(_table(spark, d, "documents"))


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return extraction.extract(_table(spark, d, "pages"))


@query("op9_mixing", mixing.MIX_SQL)
def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op10_substring_dedup", substrings.REPEATS_SQL)
def op10_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_alignment")
def op11_alignment(spark: SparkSession, d: str) -> DataFrame:
    return alignment.align(_table(spark, d, "documents"), tokenizer_path(alignment.FIRST), tokenizer_path(alignment.SECOND))


@query("op12_vector_codes", vector_codes.codes_sql())
def op12_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return vector_codes.encode(_table(spark, d, "embeddings"))


@query("op13_chat", chat.CHAT_SQL)
def op13_chat(spark: SparkSession, d: str) -> DataFrame:
    return chat.format_conversations(_table(spark, d, "conversations"))
