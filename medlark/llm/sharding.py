"""Proportional stratified interleaving of documents into shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import ROWS_PER_BUCKET, keyed_order, running_sums


def phase(seed: str, source: Column) -> Column:
    """Where the ranks of a source start, from 0 to 1."""
    return keyed_order(seed + "-phase", source) / float(2 ** 60)


def interleave(
    docs: DataFrame, shards: int, seed: str = "shards", id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Deal documents into ``shards`` so that each has the mixture of the whole.

    Rows are shuffled by a seeded hash and ranked within their source; the fractional rank
    (rank - u) / rows of the source orders all rows, and that order is cut into shards whose
    counts differ by one at most. The share u, from 0 to 1, is a seeded hash of the source, so that sources of
    few rows do not all meet in the middle. Both rankings run in buckets of bounded size: hash ranges of a
    source, then ranges of the fraction, so a source with most rows is no one's single task.

    Returns doc_id, source, size (UTF-8 bytes + 8), text_crc32, shard and slot (gapless from 0).
    A null text has size 8 and the CRC of the empty text; a null source is a source of its own;
    a null id is a value like others. Repeated rows each get a place; rows that agree in id, source
    and text are interchangeable. With fewer rows than shards some shards stay empty. Other columns
    are ignored.
    """
    narrow = cut_lineage(docs.select(
        col(id_col).alias("doc_id"), col(source_col).alias("source"),
        (F.coalesce(F.octet_length(col(text_col)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        keyed_order(seed, col(id_col)).alias("_key")))
    rows = narrow.count()
    ties = ["doc_id", "text_crc32", "size"]
    ranked = running_sums(narrow, ["source"], "_key", ties, {"_rank": F.lit(1)}, {"_of": "_rank"},
                          rows, rows_per_bucket)
    fraction = (F.col("_rank") + phase(seed, F.col("source"))) / F.col("_of")
    # Uniform in every source, and over sources of one row as well: equal ranges have near-equal counts.
    ranges = rows // rows_per_bucket + 1
    placed = ranked.select(
        *narrow.columns, fraction.alias("_fraction"),
        F.least(F.floor(fraction * ranges), F.lit(ranges - 1)).alias("_range"))
    first = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(first), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy("_fraction", "source", "_key", *ties)
    place = F.col("_before") + F.row_number().over(inside) - 1
    shard = F.expr(f"_place * {shards} div {max(rows, 1)}")
    start = F.expr(f"(_shard * {rows} + {shards - 1}) div {shards}")
    return (
        placed.join(offsets, F.col("_range") == F.col("_at"))
        .withColumn("_place", place).withColumn("_shard", shard)
        .select("doc_id", "source", "size", "text_crc32", F.col("_shard").cast("int").alias("shard"),
                (F.col("_place") - start).cast("long").alias("slot")))
