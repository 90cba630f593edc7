"""Running totals over a global order, of one column or of many at once, without a one-task window.

Rows are range-partitioned by (group, value) by Spark and summed inside their partition as they come, sorted. The
partitions are stored with their numbers; totals per partition become offsets, a thousand partitions at a time. No edge is a
part of any plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col

ROWS_PER_BUCKET = 500_000
_PARTS_TOGETHER = 1_000


def _offsets(totals: DataFrame, group: str, part: str, sums: dict[str, str]) -> DataFrame:
    """Per (group, part): ``_before_<new>``, what all earlier parts of the group sum up to.

    ``totals`` has the columns ``<new>`` of ``sums``. Windows hold a thousand parts, or the sums of so many.
    """
    over = F.floor(F.col(part) / _PARTS_TOGETHER)
    placed = totals.withColumn("_over", over)
    before = Window.partitionBy(group, "_over").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(group).orderBy("_over").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.select(group, part, "_over", *[
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_in_{n}") for n in sums])
    above = placed.groupBy(group, "_over").agg(*[F.sum(n).alias(n) for n in sums]).select(group, "_over", *[
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_above_{n}") for n in sums])
    return within.join(above, [group, "_over"]).select(
        group, part, *[(F.col(f"_in_{n}") + F.col(f"_above_{n}")).alias(f"_before_{n}") for n in sums])


def line_numbers(df: DataFrame, uniform: str, ties: list[str], name: str, rows: int,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Number all rows from 1 in order of a uniform draw in (0, 1), then ``ties``.

    Equal ranges of a uniform draw have near-equal counts, so no edges need be looked for.
    """
    buckets = rows // rows_per_bucket + 1
    cut = df.withColumn("_bucket", F.floor(col(uniform) * buckets)).withColumn("_all", F.lit(0))
    counts = cut.groupBy("_all", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("_bucket").orderBy(uniform, *[col(t) for t in ties])
    numbered = cut.withColumn("_line", F.row_number().over(inside)).join(
        _offsets(counts, "_all", "_bucket", {"n": "n"}), ["_all", "_bucket"])
    return numbered.select(*[col(c) for c in df.columns], (F.col("_line") + F.col("_before_n")).alias(name))


def _cumulative(sums: dict[str, str], group: str | None):
    """A function of sorted batches: the sums so far, anew for every group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, dict.fromkeys(sums, 0)
        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column(group).to_numpy(zero_copy_only=False) if group else np.zeros(len(batch), np.int64)
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            added = []
            for new, old in sums.items():
                x = batch.column(old).to_numpy(zero_copy_only=False)
                total = np.cumsum(x)
                base = np.repeat(total[starts] - x[starts], np.diff(np.append(starts, len(x))))
                total = total - base
                if groups[0] == last:
                    total[: starts[1] if len(starts) > 1 else len(x)] += carry[new]
                carry[new] = total[-1]
                added.append(pa.array(total))
            last = groups[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *sums])

    return run


def running_totals(
    df: DataFrame, order: str, sums: dict[str, str], rows: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET, group: str | None = None,
) -> DataFrame:
    """Add ``{new: sum of column}`` over all rows of the group up to and with the current one.

    ``order`` must be unique within ``group`` and neither may be null: collapse ties first (that is also
    what takes the heat out of a value held by a third of the rows). Sums are of longs or doubles. Pass
    ``rows`` for a table that is stored already; without, it is stored here.
    """
    if rows is None:
        # Read twice: for the ranges, then for the sums.
        df = cut_lineage(df)
        rows = df.count()
    keys = [*([group] if group else []), order]
    kinds = {n: T.DoubleType() if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else T.LongType()
             for n, c in sums.items()}
    if rows <= rows_per_bucket:
        window = Window.partitionBy(group or F.lit(0)).orderBy(order)
        return df.select("*", *[F.sum(c).over(window).cast(kinds[n]).alias(n) for n, c in sums.items()])
    ranged = df.repartitionByRange(rows // rows_per_bucket + 1, *map(col, keys)).sortWithinPartitions(*map(col, keys))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, k) for n, k in kinds.items()]])
    local = cut_lineage(ranged.mapInArrow(_cumulative(sums, group), schema).withColumn("_part", F.spark_partition_id()))
    by = group or "_all"
    local = local if group else local.withColumn("_all", F.lit(0))
    totals = local.groupBy(by, "_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    joined = local.join(_offsets(totals, by, "_part", sums), [by, "_part"])
    return joined.select(*[col(c) for c in df.columns], *[
        (F.col(n) + F.col(f"_before_{n}")).cast(kinds[n]).alias(n) for n in sums])
