"""Profiles of tables and columns."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlark.functions.moments import pair_moments
from medlark.functions.quantiles import profile
from medlark.functions.stats import WIDE, adjusted_skew
from medlark.functions.types import col, numeric_columns, rows_from_struct
from medlark.functions.values import hashed_distinct, short_value

UNKNOWN = "Unknown"
#: Pairs of columns up to which one aggregate of its own each is the faster scan; the figures are the same.
FEW_PAIRS = 100


def missing_profile(df: DataFrame) -> DataFrame:
    """(column_name, missing_count, missing_share) per column, from one aggregate."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    structs = []
    for i, c in enumerate(cols):
        missing = F.col("rows") - F.col(f"c{i}")
        structs.append(F.struct(
            F.lit(c).alias("column_name"), missing.alias("missing_count"),
            F.coalesce(F.try_divide(missing.cast("double"), F.col("rows").cast("double")),
                       F.lit(0.0)).alias("missing_share")))
    return rows_from_struct(one, structs)


def distinct_profile(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """(column_name, n_distinct) of non-null values.

    Values are told apart by 128 bits of hash, and only hashes are exchanged; ``exact=False`` uses
    sketches and shuffles nothing but those.
    """
    cols = cols or df.columns
    if not exact:
        one = df.agg(*[F.approx_count_distinct(col(c), 0.02).alias(f"c{i}")
                       for i, c in enumerate(cols)])
        return rows_from_struct(one, [
            F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_distinct"))
            for i, c in enumerate(cols)])
    if len(cols) <= WIDE:
        one = df.agg(*[F.count_distinct(short_value(df, c)).alias(f"c{i}") for i, c in enumerate(cols)])
        return rows_from_struct(one, [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_distinct"))
                                      for i, c in enumerate(cols)])
    names = F.array(*map(F.lit, cols))
    return hashed_distinct(df, cols).select(F.get(names, F.col("i")).alias("column_name"), F.col("n").alias("n_distinct"))


def numeric_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, range, mean, sample std and variance, exact quartiles and adjusted skew."""
    cols = cols or numeric_columns(df)
    parts = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp, "var": F.var_samp, "skew": adjusted_skew}
    found = profile(df, {c: col(c) for c in cols}, [0.25, 0.5, 0.75], parts)
    rows = [(c, n, *[None if told[p] is None else float(told[p]) for p in parts], *quartiles)
            for c, (n, quartiles, told) in found.items()]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, n long, " + ", ".join(f"{p} double" for p in [*parts, "q1", "median", "q3"]))


def mode_of(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, mode_value): the most frequent value as text.

    Of equally frequent ones the smallest; ``Unknown`` if there is no value.
    Values are counted before anything meets in one group, so a value held by
    most rows costs no more than a rare one.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).cast("string").alias("value"))
        for c in cols])
    counts = (
        df.select(F.explode(pairs).alias("_p")).select("_p.*")
        .groupBy("column_name", "value").agg(F.count("value").alias("n"))
    )
    first = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("k"), "value")))
    return counts.groupBy("column_name").agg(
        F.coalesce(first["value"], F.lit(UNKNOWN)).alias("mode_value"))


def label_rate(df: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    """Rows and share of ones of a 0/1 label."""
    return df.groupBy(*[col(b) for b in by]).agg(
        F.count(col(label)).alias("n"), F.avg(col(label)).alias("rate"))


def _number(c: str) -> Column:
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(a, b, r): Pearson correlation of every pair once, over rows where both have values, from one scan.

    Null where a pair has no two rows or one side has no spread over them.
    """
    cols = cols or numeric_columns(df)
    if math.comb(len(cols), 2) <= FEW_PAIRS:
        one = df.agg(F.lit(0), *[F.corr(_number(a), _number(b)).alias(f"r{i}") for i, (a, b) in enumerate(combinations(cols, 2))])
        return rows_from_struct(one, [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.nanvl(F.col(f"r{i}"), F.lit(None).cast("double")).alias("r"))
                                      for i, (a, b) in enumerate(combinations(cols, 2))])
    r = pair_moments(df, [col(c) for c in cols]).correlation()
    rows = [(cols[i], cols[j], None if math.isnan(r[i, j]) else float(r[i, j]))
            for i, j in combinations(range(len(cols)), 2)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def group_size_profile(df: DataFrame, by: list[str | Column], k: int = 5) -> DataFrame:
    """One row on the group sizes: groups, smallest, mean, groups below ``k``."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("_n").alias("size_min"),
        F.avg("_n").alias("size_mean"),
        F.count_if(F.col("_n") < k).alias("n_below_k"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins, the last one closed; empty bins are listed."""
    row = df.agg(F.min(col(column)).cast("double").alias("lo"),
                 F.max(col(column)).cast("double").alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    spark = df.sparkSession
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    at = F.floor((col(column) - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo))
    counts = (
        df.where(col(column).isNotNull())
        .groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (hi - lo) / bins
    every = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("hi"))
    # ``bins`` rows on each side.
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def audit_rollup(audit: DataFrame) -> DataFrame:
    """Per status: tables, total rows, columns and size, and mean missing rate."""
    return audit.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.sum("rows_after").alias("total_rows"),
        F.sum("cols_after").alias("total_cols"),
        F.coalesce(F.sum("size_kb"), F.lit(0.0)).alias("total_kb"),
        F.avg("missing_rate").alias("mean_missing_rate"),
    )


def largest_tables(audit: DataFrame, n: int = 20) -> DataFrame:
    """(table_name, rows_after, cols_after, size_kb) of the ``n`` tables with most rows, equal ones in name order."""
    return audit.orderBy(F.col("rows_after").desc_nulls_last(), "table_name").limit(n).select(
        "table_name", "rows_after", "cols_after", "size_kb")


def anomaly_summary(anomalies: DataFrame, by: list[str] = ()) -> DataFrame:
    """Alerts per direction."""
    return anomalies.groupBy(*by, "type").agg(F.count(F.lit(1)).alias("n"))
