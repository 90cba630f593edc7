"""The values of many text columns from one scan: counts, the most frequent, levels and ranks, and distinct counts by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.ranking import ROWS_PER_BUCKET, running_totals
from medlark.functions.storage import cut_lineage
from medlark.functions.types import col


class TextValues:
    """(i, value, n): how often each column, by number, holds each value as text; counted before the shuffle, stored once."""

    def __init__(self, df: DataFrame, cols: list[str]):
        self.cols = list(cols)
        cells = F.array(*[F.struct(F.lit(i).alias("i"), col(c).cast("string").alias("value")) for i, c in enumerate(cols)])
        self.counts = cut_lineage(
            df.select(F.inline(cells)).where(F.col("value").isNotNull())
            .groupBy("i", "value").agg(F.count(F.lit(1)).alias("n")))
        told = self.counts.groupBy("i").agg(
            F.count(F.lit(1)).alias("distinct"), F.sum(F.octet_length("value") + 32).alias("bytes"),
            F.min(F.struct((-F.col("n")).alias("k"), "value"))["value"].alias("mode")).collect()
        found = {r["i"]: r for r in told}
        #: Distinct values, their bytes and the most frequent one (of equal ones the smallest; None if there is none).
        self.distinct = {c: found[i]["distinct"] if i in found else 0 for i, c in enumerate(cols)}
        self.bytes = {c: found[i]["bytes"] if i in found else 0 for i, c in enumerate(cols)}
        self.mode = {c: found[i]["mode"] if i in found else None for i, c in enumerate(cols)}
        self._ranks: DataFrame | None = None

    def add_missing(self, fills: dict[str, str]) -> None:
        """Columns without any value get one."""
        for c, value in fills.items():
            self.distinct[c] = self.distinct[c] or 1
            self.mode[c] = value

    def levels(self, cols: list[str]) -> dict[str, list[str]]:
        """Sorted values of columns that have few."""
        wanted = [self.cols.index(c) for c in cols]
        out: dict[str, list[str]] = {c: [] for c in cols}
        for r in self.counts.where(F.col("i").isin(wanted)).select("i", "value").collect() if wanted else []:
            out[self.cols[r["i"]]].append(r["value"])
        # Spark compares texts by their bytes.
        return {c: sorted(v, key=lambda x: x.encode()) for c, v in out.items()}

    def ranks(self, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
        """(value, code): codes from 0 in text order; the ranks of all columns are worked out and stored together."""
        if self._ranks is None:
            once = self.counts.select("i", "value", F.lit(1).cast("long").alias("one"))
            self._ranks = running_totals(once, "value", {"rank": "one"}, sum(self.distinct.values()), rows_per_bucket, "i")
        return self._ranks.where(F.col("i") == self.cols.index(column)).select(
            "value", (F.col("rank") - 1).cast("long").alias("code"))


def short_value(df: DataFrame, c: str) -> Column:
    """The value itself if it takes eight bytes or so, else 128 bits of hash; null stays null."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col(c)
    value = F.to_json(F.struct(col(c))) if isinstance(kind, (T.MapType, T.VariantType)) else col(c)
    return F.when(col(c).isNotNull(), F.struct(F.xxhash64(F.lit(1), value).alias("a"), F.xxhash64(F.lit(2), value).alias("b")))


def hashed_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, n): distinct non-null values by column number, told apart by 128 bits of hash.

    Pairs of hashes are folded in each task, so no value itself is ever exchanged. Two values of one column share their hashes
    with a chance of n^2 / 2^129.
    """
    def plain(c: str):
        kind = df.schema[c].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            # One zero, one NaN.
            x = col(c) + F.lit(0.0)
            return F.when(F.isnan(x), F.lit(float("nan"))).otherwise(x)
        return F.to_json(F.struct(col(c))) if isinstance(kind, (T.MapType, T.VariantType)) else col(c)

    cells = F.array(*[F.when(col(c).isNotNull(), F.struct(
        F.lit(i).alias("i"), F.xxhash64(F.lit(1), plain(c)).alias("a"), F.xxhash64(F.lit(2), plain(c)).alias("b")))
        for i, c in enumerate(cols)])
    pairs = df.select(F.explode(F.array_compact(cells)).alias("_p")).select("_p.*")
    found = pairs.groupBy("i", "a", "b").agg(F.lit(1).alias("one")).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("i"))
    return every.join(found, "i", "left").select("i", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
