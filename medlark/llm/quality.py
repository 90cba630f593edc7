"""Quality rules: counts of the text itself, then a hashed n-gram likelihood ratio."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlark.functions.types import col
from medlark.llm.common import words_of

#: Buckets of the hashed words and word pairs.
BUCKETS = 1 << 16
#: Trusted counts are drawn to what the raw corpus lets expect, with so many counts' weight.
SMOOTHING = 10.0
#: Mean log-likelihood ratio per n-gram below which a document goes.
LEAST_RATIO = -0.5
#: Labelled ids are broadcast up to so many, else joined by a shuffle.
MOST_BROADCAST = 2_000_000
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def _ngrams(words: Column, buckets: int) -> Column:
    """Buckets of all words, of all pairs of neighbours and of the last three characters of words.

    Endings keep the signal where words are rare: what a corpus hangs on its words is frequent
    in it at any size.
    """
    n = F.greatest(F.size(words) - 1, F.lit(0))

    def bucket(kind: int, *parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(kind), *parts), F.lit(buckets)).cast("int")

    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: bucket(2, a, b))
    ends = F.transform(words, lambda w: bucket(3, F.substring(w, -3, 3)))
    return F.concat(F.transform(words, lambda w: bucket(1, w)), pairs, ends)


def count_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, _row, _words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    ``_row`` has all columns of the row as a struct.

    Repeated windows are found inside the row: hashes of all windows of three words are sorted
    with their places, and equal neighbours mark the places that they cover.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    row = F.struct(*[col(c) for c in docs.columns]).alias("_row")
    split = docs.select(row, col(id_col).alias("doc_id"), text.alias("_text"), words_of(text).alias("_words"),
                        lines.alias("_lines"))
    last = F.size("_words") - 3
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i"))))
    hashed = split.withColumn("_sorted", F.sort_array(F.coalesce(
        windows, F.array().cast("array<struct<h:bigint,i:int>>"))))

    def twice(e: Column, k: Column) -> Column:
        beside = [F.get("_sorted", k + step)["h"].eqNullSafe(e["h"]) for step in (-1, 1)]
        return beside[0] | beside[1]

    found = hashed.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", twice), lambda e: e["i"])))
    n = F.greatest(F.size("_at") - 1, F.lit(0))
    gaps = F.zip_with("_at", F.slice("_at", F.lit(2), n), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return found.select(
        "_row", "doc_id", "_words", F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g).alias("n_repeat_words"))


def ngram_weights(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
    id_col: str = "doc_id", text_col: str = "text",
) -> list[float]:
    """Per bucket the log ratio of its share in trusted documents to its share in all documents.

    Counts cover every document; they are folded per task, so what is shuffled is bounded by
    tasks x buckets and the driver gets one row per bucket.
    """
    ids = trusted.select(col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    flagged = docs.select(col(id_col).alias("doc_id"), words_of(col(text_col)).alias("_words")).join(
        ids, F.col("doc_id") == F.col("_id"), "left")
    counts = flagged.select(F.col("_id").isNotNull().cast("long").alias("_t"),
                            F.explode(_ngrams(F.col("_words"), buckets)).alias("_b")) \
        .groupBy("_b").agg(F.sum("_t").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    good, raw = [0] * buckets, [0] * buckets
    for r in counts:
        good[r["_b"]], raw[r["_b"]] = r["t"], r["n"]
    if not sum(good):
        return [0.0] * buckets
    share = sum(good) / sum(raw)
    return [math.log((g + smoothing) / (n * share + smoothing)) for g, n in zip(good, raw)]


def judged(
    docs: DataFrame, trusted: DataFrame, least_ratio: float = LEAST_RATIO, buckets: int = BUCKETS,
    smoothing: float = SMOOTHING, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every row as ``_row`` with doc_id, the counts, base_failed, kept and ratio; see ``quality_rules``."""
    weights = ngram_weights(docs, trusted, buckets, smoothing, id_col, text_col)
    # A constant of the plan: bounded by the buckets, folded once.
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(_ngrams(F.col("_words"), buckets), F.lit(0.0), lambda a, b: a + F.get(table, b))
    ratio = F.when(F.col("n_words") > 0, total / (3 * F.col("n_words") - 1)).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    counted = count_rules(docs, id_col, text_col).select(
        "_row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), ratio.alias("ratio"))
    return counted.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least_ratio))


def quality_rules(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """Judge every document by counts and by a hashed n-gram likelihood ratio.

    N-grams are hashed into buckets; two multinomials, over the trusted documents and over the whole
    corpus, give each bucket a log ratio, and the mean over a document's n-grams is compared with a fixed
    threshold. ``trusted`` has the ids of trusted documents. Options are those of ``judged``.

    Returns doc_id, the counts, base_failed, kept and ratio. A null or blank text has no words and
    fails the base rules; its ratio is 0. Without trusted documents every ratio is 0, so only the base
    rules decide. Repeated rows are judged each, and alike. Null ids are judged but never trusted.
    Other columns are ignored. All work is done by SQL functions inside the row.
    """
    return judged(docs, trusted, **options).drop("_row")


def keep_good(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The rows that the rules keep, as they are; text is not shuffled.

    The choice is a generator, not a filter: a filter would be pushed below the projections, and with it
    everything that they work out once per row would be worked out per word.
    """
    marked = judged(docs, trusted, **options).select(F.when(F.col("kept"), F.array("_row")).alias("_kept"))
    return marked.select(F.explode_outer("_kept").alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")
