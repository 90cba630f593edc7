"""Statistics of many columns in one aggregate job; a few numbers come back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlark.functions.types import col

# Beyond this many columns they are unpivoted first: the generated code for one
# aggregate per column and statistic would grow too large to be compiled.
WIDE = 12


def adjusted_skew(c: Column) -> Column:
    """Bias-adjusted skewness; Spark's own ``skewness`` is the population one."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


AGGREGATES = {
    "n": lambda c: F.count(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "mean": lambda c: F.avg(c),
    "std": lambda c: F.stddev_samp(c),
    "std_pop": lambda c: F.stddev_pop(c),
    "var": lambda c: F.var_samp(c),
    "skew": lambda c: adjusted_skew(c),
    "approx_distinct": lambda c: F.approx_count_distinct(c, 0.02),
    "distinct": lambda c: F.count_distinct(c),
}


def column_stats(
    df: DataFrame, cols: list[str], wanted: list[str], fill: float | None = None
) -> dict[str, dict]:
    """``{column: {statistic: value}}`` from one job; least and greatest values keep their column's type."""
    if not cols:
        return {}

    def value(name: str) -> Column:
        return col(name) if fill is None else F.coalesce(col(name), F.lit(fill))

    if len(cols) <= WIDE:
        row = df.agg(*[AGGREGATES[w](value(c)).alias(f"{i}_{w}")
                       for i, c in enumerate(cols) for w in wanted]).first()
        return {c: {w: row[f"{i}_{w}"] for w in wanted} for i, c in enumerate(cols)}
    # One value column per type, so that longs and decimals stay what they are.
    as_text = set(wanted) <= {"n", "distinct", "approx_distinct"}
    types = ["string" if as_text else t for t in (df.select(*[value(c) for c in cols]).schema[i].dataType.simpleString()
                                                   for i in range(len(cols)))]
    kinds = sorted(set(types))
    cells = F.array(*[F.struct(F.lit(i).alias("i"), *[
        (value(c).cast(k) if k == t else F.lit(None).cast(k)).alias(f"v{j}") for j, k in enumerate(kinds)])
        for i, (c, t) in enumerate(zip(cols, types))])
    long = df.select(F.inline(cells))
    rows = long.groupBy("i").agg(*[
        AGGREGATES[w](F.col(f"v{j}")).alias(f"{j}_{w}") for j in range(len(kinds)) for w in wanted]).collect()
    found = {r["i"]: r for r in rows}
    empty = {w: 0 if w in ("n", "distinct", "approx_distinct") else None for w in wanted}
    return {c: {w: found[i][f"{kinds.index(t)}_{w}"] for w in wanted} if i in found else dict(empty)
            for i, (c, t) in enumerate(zip(cols, types))}


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count and nulls per column, in one job."""
    cols = df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(cols)],
    ).first()
    return row["rows"], {c: row["rows"] - row[f"c{i}"] for i, c in enumerate(cols)}


def small_distinct_counts(df: DataFrame, cols: list[str], limit: int = 10) -> dict[str, int]:
    """Distinct non-null values per column, exact wherever it is near ``limit``.

    A sketch clears the wide columns first; only columns it puts below ten
    times the limit are counted exactly, and those shuffle a handful of values
    per task. For the others the sketch value is returned.
    """
    if not cols:
        return {}
    approx = {c: s["approx_distinct"] for c, s in column_stats(df, cols, ["approx_distinct"]).items()}
    near = [c for c in cols if approx[c] <= 10 * limit]
    exact = column_stats(df, near, ["distinct"]) if near else {}
    return {c: exact[c]["distinct"] if c in exact else approx[c] for c in cols}
