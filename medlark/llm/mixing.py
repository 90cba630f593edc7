"""Mix sources to target weights, to the word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.llm.common import (
    ROWS_PER_BUCKET, keyed_order, keyed_order_sql, running_sums, words_of,
)

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_EPOCHS) -> DataFrame:
    """Targets of sources (source, source_size): shares by weight, none above ``most`` times its size.

    Sources in order of code points, null last, take the weights in turn. Resharing the excess
    until none is above ends at the level where sum(min(most * size, level * weight)) is the
    whole: sources are full in order of size / weight, so running sums find that level at once.
    A table of sources is small beside that of documents; its windows are not split.
    """
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]),
                        (F.pmod(F.row_number().over(listed) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("_w", turn.cast("double"))
    ratio = F.col("_most") / F.col("_w")
    fill = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    level = (
        weighed.withColumn("_most", F.col("source_size").cast("double") * most)
        .withColumn("_ratio", ratio)
        .withColumn("_full", F.coalesce(F.sum("_most").over(earlier), F.lit(0.0)))
        .withColumn("_left_w", F.sum("_w").over(everywhere) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0)))
        .withColumn("_all", F.sum(F.col("source_size").cast("double")).over(everywhere) * share)
        .withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_left_w"))
        # The first source that is not full at its level, and all after it, share what is left.
        .withColumn("_open", F.min(F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_level")))
                    .over(everywhere)))
    target = F.when(F.col("_open").isNull() | (F.col("_ratio") < F.col("_open._ratio")), F.col("_most")) \
        .otherwise(F.least(F.col("_open._level") * F.col("_w"), F.col("_most")))
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    most: int = MOST_EPOCHS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", rows_per_bucket: int = ROWS_PER_BUCKET, row_col: str | None = None,
) -> DataFrame:
    """How many words of each document the mixture takes.

    Documents get hash-random keys; each source is sorted by key in hash ranges, running sums of
    words are built from range totals, and the source is cut at its exact budget. Whole epochs
    come first: of a budget of e sizes and a rest every document is taken e times, and the rest
    goes to the first documents by key; the one at the cut gives just the words still missing.

    Returns doc_id, size (words), source, source_size, target, taken. A null text has no words, a
    null source is a source of its own, a source without words has target 0. Repeated rows count
    one by one; of rows that agree in id and size either may be the one at the cut. Other columns
    are ignored, but a key of rows named by ``row_col`` comes back as ``_row`` and decides between such
    rows. Reruns agree: nothing but the rows themselves decides.
    """
    row = [] if row_col is None else ["_row"]
    narrow = cut_lineage(docs.select(
        col(id_col).alias("doc_id"), col(source_col).alias("source"),
        F.size(words_of(col(text_col))).cast("long").alias("size"),
        keyed_order(seed, col(id_col)).alias("_key"), *[col(row_col).alias(r) for r in row]))
    rows = narrow.count()
    sums = running_sums(narrow, ["source"], "_key", ["doc_id", "size", *row], {"_before": F.col("size")},
                        {"_source_size": "_before"}, rows, rows_per_bucket)
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    rest = F.col("_budget") - F.col("_epochs") * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before")))
    return (
        sums.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_budget", budget).withColumn("_epochs", epochs).withColumn("_rest", rest)
        .select(*row, "doc_id", "source", "size", "source_size", "target",
                (F.col("_epochs") * F.col("size") + last).cast("long").alias("taken")))


def apply_mix(docs: DataFrame, taken: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the mixture: a document as often as it is taken, the one at a cut shortened.

    ``taken`` is found by id here, so an id, null too, must stand for one row: else this raises, and
    :func:`mixed_rows` is to be used. The columns of ``docs`` come back unchanged but for the text of
    the part at a cut, whose words are joined by a space.
    """
    if not taken.groupBy("doc_id").count().where("count > 1").isEmpty():
        raise ValueError("ids stand for several rows; use mixed_rows")
    return _apply(docs.select(col(id_col).alias("_row"), F.struct(*[col(c) for c in docs.columns]).alias("_doc")),
                  taken.withColumn("_row", F.col("doc_id")), docs.columns, text_col)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """The rows of the mixture of ``docs`` as in :func:`apply_mix`, whatever the ids: rows get a key of their own.

    The key is stored with the row, so that the plan and the rows it is joined to have the same one.
    """
    keyed = cut_lineage(docs.select(F.monotonically_increasing_id().alias("_row"),
                                    F.struct(*[col(c) for c in docs.columns]).alias("_doc")))
    read = keyed.select("_row", *[F.col("_doc").getField(c).alias(c) for c in {id_col, text_col, source_col}])
    taken = mix(read, id_col=id_col, text_col=text_col, source_col=source_col, row_col="_row", **options)
    return _apply(keyed, taken, docs.columns, text_col)


def _apply(keyed: DataFrame, taken: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """Rows (_row, _doc) as often as planned under the same _row."""
    plan = taken.select(F.col("_row").alias("_id"), F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    joined = keyed.join(plan, F.col("_row").eqNullSafe(F.col("_id")))
    whole = F.when(F.col("_size") > 0, F.expr("_taken div _size")).otherwise(F.lit(0))
    part = F.col("_taken") - whole * F.col("_size")
    # A text without words costs nothing and is kept once.
    copies = F.when(F.col("_size") == 0, F.array(F.lit(-1).cast("long"))).otherwise(F.filter(
        F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.array(part)),
        lambda n: n != 0))
    given = F.col("_doc").getField(text_col)
    shortened: Column = F.concat_ws(" ", F.slice(words_of(given), 1, F.greatest(F.col("_part"), F.lit(1)).cast("int")))
    text = F.when(F.col("_part") < 0, given).otherwise(shortened)
    exploded = joined.withColumn("_part", F.explode(copies))
    return exploded.select(*[(text if c == text_col else F.col("_doc").getField(c)).alias(c) for c in columns])


#: The mixture in SQL; the level is found by trying every set of full sources.
MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, {keyed_order_sql(SEED, 'doc_id')} AS k,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS most,
      [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
lv AS (SELECT a.most / a.w AS r,
       (1.5::DOUBLE * (SELECT sum(size) FROM d)
        - coalesce((SELECT sum(b.most) FROM s b WHERE b.most / b.w < a.most / a.w), 0))
       / (SELECT sum(b.w) FROM s b WHERE b.most / b.w >= a.most / a.w) AS level FROM s a),
t AS (SELECT source, source_size, least(most, w * coalesce((SELECT min_by(level, r) FROM lv WHERE level < r), 'inf'::DOUBLE)) AS target FROM s),
c AS (SELECT d.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken FROM c
"""
