"""From raw documents to packed sequences: quality, near copies, repeats, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.llm import mixing, ngram_join, packing, quality, substrings
from medlark.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the trusted ones are those labelled as good."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word sequences that an earlier document has go."""
    return _recounted(substrings.without_repeats(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return _recounted(mixing.mixed_rows(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack(docs, tokenizer_path())


def _recounted(docs: DataFrame) -> DataFrame:
    n = F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", n)


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: Token ids cannot be had in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is stored, since the next reads it several times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
