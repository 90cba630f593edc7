"""Imputation, outlier clipping, encoding and scaling.

Statistics come from aggregate jobs and go back in as literals, so the
cleaning itself is one narrow projection per step.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlark.functions.joins import lookup_join
from medlark.functions.moments import pattern_products
from medlark.functions.neighbours import CELL_ROWS, CellTree
from medlark.functions.quantiles import Filled, counts_and_quantiles, exact_quantiles
from medlark.functions.ranking import ROWS_PER_BUCKET
from medlark.functions.stats import column_stats, small_distinct_counts
from medlark.functions.storage import cut_lineage
from medlark.functions.types import col, numeric_columns, other_columns, replace_columns
from medlark.functions.values import TextValues
from medlark.operators.profile import mode_of

# Neighbours that are averaged.
NEIGHBOURS = 5
# Sets of absent columns whose sums one task and the driver hold together.
MOST_PATTERNS = 1_000
MIN_VALUES = 10
ONEHOT_MAX = 10
MOST_LEVELS = 100


# --- imputation ---------------------------------------------------------------

def impute_median(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null becomes the exact median; a column without values stays null."""
    cols = cols or numeric_columns(df)
    medians = exact_quantiles(df, cols, [0.5])
    return replace_columns(df, {
        c: F.coalesce(col(c).cast("double"), F.lit(medians[c][0])) for c in cols
        if medians[c][0] is not None})


def impute_mode(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null becomes the most frequent value of the column, ``Unknown`` if it has none."""
    cols = cols or other_columns(df)
    if not cols:
        return df
    modes = {r["column_name"]: r["mode_value"] for r in mode_of(df, cols).collect()}
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for c in cols:
        value = F.lit(modes.get(c, "Unknown")).try_cast(types[c])
        new[c] = F.coalesce(col(c), value)
    return replace_columns(df, new)


def impute_knn(
    df: DataFrame, cols: list[str], key: str, k: int = NEIGHBOURS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Null becomes the mean of the ``k`` nearest rows that have the value, at every table size.

    The distance runs over the columns both rows have, scaled up for absent ones; equal distances go in
    key order. A row with no comparable donor gets the column mean. Equal rows are searched for, and found, once; the
    search visits only cells of about ``cell_rows`` points whose bound beats what is at hand.
    """
    means = {c: s["mean"] for c, s in column_stats(df, cols, ["mean"]).items()}
    cols = [c for c in cols if means[c] is not None]
    if not cols:
        return df
    names = [f"v{i}" for i in range(len(cols))]
    values = [F.nanvl(col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    slim = cut_lineage(df.select(col(key).alias("key"), *[v.alias(n) for v, n in zip(values, names)]))
    wanted = [F.when(F.col(n).isNull(), F.lit(i)) for i, n in enumerate(names)]
    asking = cut_lineage(slim.where(F.coalesce(*wanted).isNotNull()).select(*names).distinct()
                         .withColumn("r", F.monotonically_increasing_id()))
    queries = asking.select("r", *names, F.explode(F.array_compact(F.array(*wanted))).alias("j"))
    found = CellTree(slim, names, k, cell_rows).nearest_means(queries)
    filled = found.groupBy("r").agg(*[F.max(F.when(F.col("j") == i, F.col("mean"))).alias(f"_f{i}") for i in range(len(cols))])
    # Stored, as a caller may scan the filled table often: no scan searches again.
    answers = cut_lineage(asking.join(filled, "r").select(*[F.col(n).alias(f"_{n}") for n in names], *[f"_f{i}" for i in range(len(cols))]))
    same = reduce(and_, [v.eqNullSafe(F.col(f"_{n}")) for v, n in zip(values, names)])
    done = replace_columns(df.join(answers, same, "left"), {
        c: F.coalesce(v, F.col(f"_f{i}"), F.lit(means[c])) for i, (c, v) in enumerate(zip(cols, values))})
    return done.select([col(c) for c in df.columns])


def impute_mice(
    df: DataFrame, cols: list[str], iters: int = 10, tol: float = 1e-3, ridge: float = 1e-9,
    most_patterns: int = MOST_PATTERNS,
) -> DataFrame:
    """Round-robin regression: each incomplete column on all the others, from mean fill.

    Rounds end after ``iters`` or when no fill value moves by ``tol`` of its column's range. With one incomplete column
    the first round is the answer. A fill is a linear function of what its row has, the same for all rows
    that lack the same columns. So the sums of products by pattern of absent columns, from one scan, are enough to solve
    every column of every round; a round scans once more to see how far fills moved. Rows with more than
    ``most_patterns`` patterns are filled round by round instead, with a scan per column.
    """
    stats = column_stats(df, cols, ["n", "mean", "min", "max", "std_pop"])
    rows = df.count()
    used = [c for c in cols if stats[c]["n"] and stats[c]["std_pop"]]
    todo = sorted((c for c in used if stats[c]["n"] < rows), key=lambda c: -stats[c]["n"])
    marks = [F.when(col(c).isNull(), F.lit(1 << min(i, 62))).otherwise(F.lit(0)).cast("long") for i, c in enumerate(todo)]
    pattern = reduce(add, marks) if marks else F.lit(0).cast("long")
    if len(todo) > 62 or (todo and df.select(pattern.alias("p")).distinct().limit(most_patterns + 1).count() > most_patterns):
        return _mice_by_scans(df, cols, used, todo, stats, iters, tol, ridge)
    mean = {c: F.coalesce(col(c).cast("double"), F.lit(stats[c]["mean"])) for c in cols}
    if not todo:
        return replace_columns(df, mean)
    z = [(col(c).cast("double") - F.lit(stats[c]["mean"])) / F.lit(stats[c]["std_pop"]) for c in used]
    products = pattern_products(df, z, pattern)
    place = {c: used.index(c) + 1 for c in todo}
    #: By pattern: every column as a linear function of (1, columns with 0 where absent).
    maps = {p: np.eye(len(used) + 1) for p in products}

    def told(scale: dict[str, float]) -> list[Column]:
        """Per incomplete column its function's value, the coefficients looked up by pattern."""
        return [reduce(add, [F.get(f"_w{i}", F.lit(k)) * (F.coalesce(z[k - 1], F.lit(0.0)) if k else F.lit(1.0))
                             for k in range(len(used) + 1)]) * F.lit(scale[c]) for i, c in enumerate(todo)]

    def with_weights(values: dict[int, np.ndarray]) -> DataFrame:
        table = df.sparkSession.createDataFrame(
            [(p, *[a[place[c]].tolist() for c in todo]) for p, a in values.items()],
            "_pattern long, " + ", ".join(f"_w{i} array<double>" for i in range(len(todo))))
        # At most ``most_patterns`` rows.
        return df.withColumn("_pattern", pattern).join(F.broadcast(table), "_pattern")

    for _ in range(iters if len(todo) > 1 else 1):
        before = {p: a.copy() for p, a in maps.items()}
        for i, c in enumerate(todo):
            have = sum(maps[p] @ g @ maps[p].T for p, g in products.items() if not p >> i & 1)
            weights = _solved(have, place[c], ridge)
            for p in maps:
                if p >> i & 1:
                    maps[p][place[c]] = weights @ maps[p]
        if len(todo) > 1:
            span = {c: stats[c]["std_pop"] / ((stats[c]["max"] - stats[c]["min"]) or 1.0) for c in todo}
            steps = {p: a - before[p] for p, a in maps.items()}
            moved = with_weights(steps).agg(F.greatest(F.lit(0.0), *[
                F.max(F.when(col(c).isNull(), F.abs(v))) for c, v in zip(todo, told(span))])).first()[0]
            if moved < tol:
                break
    fills = {c: F.coalesce(col(c).cast("double"), v + F.lit(stats[c]["mean"]))
             for c, v in zip(todo, told({c: stats[c]["std_pop"] for c in todo}))}
    return replace_columns(with_weights(maps), {**mean, **fills}).select([col(c) for c in df.columns])


def _solved(products: np.ndarray, target: int, ridge: float) -> np.ndarray:
    """Least squares of one column on all others as weights of (1, columns), from sums of products."""
    n = products[0, 0]
    others = [i for i in range(1, len(products)) if i != target]
    mean = products[0] / n
    cov = products / n - np.outer(mean, mean)
    w = np.linalg.solve(cov[np.ix_(others, others)] + ridge * np.eye(len(others)), cov[others, target])
    out = np.zeros(len(products))
    out[others] = w
    out[0] = mean[target] - w @ mean[others]
    return out


def _mice_by_scans(df: DataFrame, cols: list[str], used: list[str], todo: list[str], stats: dict, iters: int,
                   tol: float, ridge: float) -> DataFrame:
    """The same with one scan per column and round, for rows of any number of patterns."""
    mark = {c: f"_gap{i}" for i, c in enumerate(todo)}
    work = df.select(
        *[col(c) for c in df.columns if c not in cols],
        *[F.coalesce(col(c).cast("double"), F.lit(stats[c]["mean"])).alias(c) for c in cols],
        *[col(c).isNull().alias(m) for c, m in mark.items()],
    )
    for _ in range(iters if len(todo) > 1 else 1):
        moved = 0.0
        for target in todo:
            others = [c for c in used if c != target]
            guess = _linear_fit(work, target, others, mark[target], stats, ridge)
            new = F.when(F.col(mark[target]), guess).otherwise(col(target))
            if len(todo) > 1:
                span = (stats[target]["max"] - stats[target]["min"]) or 1.0
                step = work.where(F.col(mark[target])).agg(F.max(F.abs(guess - col(target)))).first()[0]
                moved = max(moved, (step or 0.0) / span)
            work = replace_columns(work, {target: new})
        if len(todo) > 1:
            work = cut_lineage(work)
        if moved < tol:
            break
    return work.select([col(c) for c in df.columns])


def _linear_fit(work: DataFrame, target: str, others: list[str], gap: str, stats: dict,
                ridge: float) -> Column:
    """Least squares of ``target`` on ``others`` over rows that have it, as an expression."""
    names = [*others, target]
    z = [(col(c) - F.lit(stats[c]["mean"])) / F.lit(stats[c]["std_pop"]) for c in names]
    products = pattern_products(work.where(~F.col(gap)), z, F.lit(0))
    weights = _solved(products[0], len(names), ridge)
    fit = F.lit(float(weights[0]))
    for v, x in zip(z[:-1], weights[1:]):
        fit = fit + F.lit(float(x)) * v
    return fit * F.lit(stats[target]["std_pop"]) + F.lit(stats[target]["mean"])


def impute_auto(df: DataFrame, cols: list[str], method: str = "mice", key: str | None = None) -> DataFrame:
    """``median``, ``knn`` or ``mice``, the same at every table size."""
    if method == "median":
        return impute_median(df, cols)
    if method == "knn":
        if key is None:
            raise ValueError("knn needs a row key")
        return impute_knn(df, cols, key)
    if method != "mice":
        raise ValueError(f"unknown method {method!r}")
    return impute_mice(df, cols)


# --- outliers -----------------------------------------------------------------

Bounds = dict[str, tuple[float, float]]


def iqr_bounds(df: DataFrame, cols: list[str] | None = None, k: float = 1.5) -> Bounds:
    """Q1 - k IQR and Q3 + k IQR of columns with at least 10 values and a nonzero IQR."""
    cols = cols or numeric_columns(df)
    return {
        c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
        for c, (n, (q1, q3)) in counts_and_quantiles(df, cols, [0.25, 0.75]).items()
        if n >= MIN_VALUES and q3 != q1
    }


def zscore_bounds(df: DataFrame, cols: list[str] | None = None, z: float = 3.0) -> Bounds:
    """Mean -/+ z sample std of columns with at least 10 values and a nonzero std."""
    cols = cols or numeric_columns(df)
    return {
        c: (s["mean"] - z * s["std"], s["mean"] + z * s["std"])
        for c, s in column_stats(df, cols, ["n", "mean", "std"]).items()
        if s["n"] >= MIN_VALUES and s["std"]
    }


def bounds_of_filled(filled: dict[str, Filled], rule: str, k: float = 1.5, z: float = 3.0) -> Bounds:
    """The bounds of ``iqr_bounds`` or ``zscore_bounds`` for columns filled with their medians; quantiles are the quartiles."""
    out = {}
    for c, f in filled.items():
        if not f.n or f.rows < MIN_VALUES:
            continue
        if rule == "iqr":
            q1, q3 = f.quantiles
            if q3 != q1:
                out[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
        elif f.std:
            out[c] = (f.mean - z * f.std, f.mean + z * f.std)
    return out


def clip_to(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Values outside their bounds move to the bound; null stays null."""
    return replace_columns(df, {
        c: F.when(col(c).isNotNull(),
                  F.least(F.greatest(col(c).cast("double"), F.lit(lo)), F.lit(hi)))
        for c, (lo, hi) in bounds.items()})


def count_clipped(df: DataFrame, bounds: Bounds) -> DataFrame:
    """One row: how many values of each column lie outside its bounds."""
    return df.agg(*[
        F.count_if((col(c) < lo) | (col(c) > hi)).alias(c) for c, (lo, hi) in bounds.items()])


def winsorize_iqr(df: DataFrame, cols: list[str] | None = None, k: float = 1.5) -> DataFrame:
    return clip_to(df, iqr_bounds(df, cols, k))


def winsorize_zscore(df: DataFrame, cols: list[str] | None = None, z: float = 3.0) -> DataFrame:
    return clip_to(df, zscore_bounds(df, cols, z))


# --- encoding -----------------------------------------------------------------

def _text(c: str) -> Column:
    return col(c).cast("string")


def encode_binary(df: DataFrame, column: str) -> DataFrame:
    """Two values become 0 and 1 in text order."""
    row = df.agg(F.min(_text(column)).alias("lo"), F.max(_text(column)).alias("hi")).first()
    return replace_columns(df, {
        column: F.when(_text(column) == row["lo"], 0).when(_text(column) == row["hi"], 1)})


def encode_onehot(df: DataFrame, column: str, levels: list[str] | None = None) -> DataFrame:
    """One 0/1 column ``column_level`` per sorted level but the first; the column goes."""
    if levels is None:
        count = small_distinct_counts(df, [column])[column]
        if count > MOST_LEVELS:
            raise ValueError(f"{column} has too many levels for indicator columns: {count}")
        levels = TextValues(df, [column]).levels([column])[column]
    flags = [
        F.coalesce(_text(column) == F.lit(v), F.lit(False)).cast("int").alias(f"{column}_{v}")
        for v in levels[1:]]
    return df.select(*[col(c) for c in df.columns if c != column], *flags)


def ordinal_levels(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """(value, code) with codes 0.. in text order, and their size in bytes."""
    values = TextValues(df, [column])
    return values.ranks(column, rows_per_bucket), values.bytes[column]


def encode_ordinal(
    df: DataFrame, column: str, unknown: int = -1, levels: DataFrame | None = None,
    levels_bytes: int | None = None, into: str | None = None,
) -> DataFrame:
    """Rank of the value among the sorted distinct values; ``unknown`` if it is not one.

    Pass the ``levels`` of another table to encode new rows the same way.
    """
    if levels is None:
        levels, levels_bytes = ordinal_levels(df, column)
    table = levels.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    keyed = df.withColumn("_value", _text(column))
    joined = lookup_join(keyed, table, ["_value"], "left", lookup_bytes=levels_bytes)
    code = F.coalesce(F.col("_code"), F.lit(unknown).cast("long"))
    done = replace_columns(joined, {into or column: code})
    return done.select([col(c) for c in done.columns if c not in ("_value", "_code")])


def encode_auto(df: DataFrame, cols: list[str] | None = None, values: TextValues | None = None,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """By distinct values: at most 1 dropped, 2 to 0/1, up to 10 to indicators, else ranks.

    The values of all columns are counted, and ranked, together; pass ``values`` if they are counted already.
    """
    cols = other_columns(df) if cols is None else cols
    if not cols:
        return df
    values = values or TextValues(df, cols)
    counts = values.distinct
    levels = values.levels([c for c in cols if 2 <= counts[c] <= ONEHOT_MAX])
    out: list[Column] = []
    added: list[Column] = []
    for c in df.columns:
        if c not in cols or counts[c] > ONEHOT_MAX:
            out.append(col(c))
        elif counts[c] == 2:
            lo, hi = levels[c]
            out.append(F.when(_text(c) == lo, 0).when(_text(c) == hi, 1).alias(c))
        elif counts[c] > 2:
            added += [F.coalesce(_text(c) == F.lit(v), F.lit(False)).cast("int").alias(f"{c}_{v}")
                      for v in levels[c][1:]]
    done = df.select(*out, *added)
    for c in cols:
        if counts[c] > ONEHOT_MAX:
            done = encode_ordinal(done, c, levels=values.ranks(c, rows_per_bucket), levels_bytes=values.bytes[c])
    return done


def encode_codes(df: DataFrame, cols: dict[str, str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``{column: new column}``: integer code per sorted distinct value, all columns ranked together."""
    values = TextValues(df, list(cols))
    for c, new in cols.items():
        df = encode_ordinal(df, c, levels=values.ranks(c, rows_per_bucket), levels_bytes=values.bytes[c], into=new)
    return df


# --- scaling ------------------------------------------------------------------

class Scaling(NamedTuple):
    """``(x - shift) / scale`` per column; a scale of 0 gives 0."""

    shift: dict[str, float]
    scale: dict[str, float]


def fit_standard(df: DataFrame, cols: list[str]) -> Scaling:
    s = column_stats(df, cols, ["mean", "std_pop"])
    return Scaling({c: s[c]["mean"] for c in cols}, {c: s[c]["std_pop"] for c in cols})


def fit_minmax(df: DataFrame, cols: list[str]) -> Scaling:
    s = column_stats(df, cols, ["min", "max"])
    known = [c for c in cols if s[c]["min"] is not None]
    return Scaling({c: float(s[c]["min"]) for c in known},
                   {c: float(s[c]["max"] - s[c]["min"]) for c in known})


def apply_scaling(df: DataFrame, fit: Scaling) -> DataFrame:
    new = {}
    for c, shift in fit.shift.items():
        if shift is None:
            continue
        scale = fit.scale[c]
        centred = col(c).cast("double") - F.lit(float(shift))
        new[c] = centred / F.lit(float(scale)) if scale else centred
    return replace_columns(df, new)


def scale_standard(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mean 0 and population std 1; a constant column becomes 0."""
    return apply_scaling(df, fit_standard(df, cols or numeric_columns(df)))


def scale_minmax(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Range 0 to 1; a constant column becomes 0."""
    return apply_scaling(df, fit_minmax(df, cols or numeric_columns(df)))
