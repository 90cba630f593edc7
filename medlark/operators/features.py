"""Feature engineering, selection and projection.

Run these before scaling: after it all variances are 1 and the log rule
cannot fire.
"""

from __future__ import annotations

import math
from itertools import combinations
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.information import neighbour_information
from medlark.functions.quantiles import exact_quantiles
from medlark.functions.stats import column_stats
from medlark.functions.types import col, numeric_columns, replace_columns
from medlark.operators.columns import LABEL_CANDIDATES, detect_label

# Fixed values of feature construction.
LOG_SKEW = 1.5
MIN_VALUES = 10
TOP_PRODUCTS = 15
TOP_POLY = 10
MIN_VARIANCE = 0.01
KEEP_FEATURES = 50
PCA_COMPONENTS = 30


def log_skewed(df: DataFrame, cols: list[str] | None = None, t: float = LOG_SKEW) -> DataFrame:
    """Add ``c_log = ln(1 + c)`` for skewed columns without negative values."""
    cols = cols or numeric_columns(df)
    stats = column_stats(df, cols, ["n", "min", "skew"])
    skewed = [
        c for c in cols
        if stats[c]["n"] >= MIN_VALUES and stats[c]["min"] >= 0
        and stats[c]["skew"] is not None and abs(stats[c]["skew"]) > t
    ]
    return df.select("*", *[F.log1p(col(c).cast("double")).alias(f"{c}_log") for c in skewed])


def cross_named(df: DataFrame, a_words: list[str] = ("bmi",), b_words: list[str] = ("age",),
                cols: list[str] | None = None) -> DataFrame:
    """Products of all columns named like ``a`` with all named like ``b``."""
    cols = cols or numeric_columns(df)
    first = [c for c in cols if any(w in c.lower() for w in a_words)]
    second = [c for c in cols if any(w in c.lower() for w in b_words)]
    new = {f"{a}_x_{b}": col(a) * col(b) for a in first for b in second}
    return replace_columns(df, new)


def by_variance(df: DataFrame, cols: list[str], fill: float | None = None) -> list[str]:
    """Columns by falling sample variance; equal ones in column order, empty ones last."""
    var = {c: s["var"] for c, s in column_stats(df, cols, ["var"], fill).items()}
    return sorted(cols, key=lambda c: -(var[c] if var[c] is not None else -1.0))


def top_variance_products(df: DataFrame, cols: list[str] | None = None, top: int = TOP_PRODUCTS
                          ) -> DataFrame:
    """All pair products of the ``top`` columns of highest variance."""
    cols = cols or numeric_columns(df)
    pairs = combinations(by_variance(df, cols)[:top], 2)
    return replace_columns(df, {f"{a}_x_{b}": col(a) * col(b) for a, b in pairs})


def poly_interactions(df: DataFrame, cols: list[str] | None = None, top: int = TOP_POLY) -> DataFrame:
    """All pair products, null as 0, of the ``top`` columns of highest variance, named ``poly_a_x_b``."""
    cols = cols or numeric_columns(df)

    def value(c: str) -> Column:
        return F.coalesce(col(c).cast("double"), F.lit(0.0))

    pairs = combinations(by_variance(df, cols)[:top], 2)
    return df.select("*", *[(value(a) * value(b)).alias(f"poly_{a}_x_{b}") for a, b in pairs])


def engineer_features(df: DataFrame, cols: list[str] | None = None,
                      a_words: list[str] = ("bmi",), b_words: list[str] = ("age",)) -> DataFrame:
    """Logs, named crosses and products over the columns the table came with."""
    cols = cols or numeric_columns(df)
    out = log_skewed(df, cols)
    out = cross_named(out, a_words, b_words, cols)
    out = top_variance_products(out, cols)
    return poly_interactions(out, cols)


def drop_low_variance(df: DataFrame, cols: list[str] | None = None, t: float = MIN_VARIANCE
                      ) -> DataFrame:
    """Without columns whose sample variance, null as 0, is below ``t``."""
    cols = cols or numeric_columns(df)
    var = column_stats(df, cols, ["var"], fill=0.0)
    gone = {c for c in cols if (var[c]["var"] or 0.0) < t}
    return df.select([col(c) for c in df.columns if c not in gone])


def mutual_information(df: DataFrame, label: str, cols: list[str], bins: int = 10) -> DataFrame:
    """(feature, mi) in nats between the label and each column cut at exact quantiles.

    The binned estimate is not equal in value to a nearest-neighbour one. One
    unpivot, counts folded before the shuffle, at most labels x bins rows per
    column after it.
    """
    edges = exact_quantiles(
        df, {c: F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols},
        [i / bins for i in range(1, bins)])
    # One row per cell, and one expression for all columns: the cuts are looked up by name.
    cuts = F.create_map(*[e for c in cols for e in (
        F.lit(c), F.lit(sorted(set(v for v in edges[c] if v is not None)) or [0.0]))])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.coalesce(col(c).cast("double"), F.lit(0.0)).alias("x")) for c in cols])
    joint = (
        df.where(col(label).isNotNull())
        .select(col(label).cast("string").alias("y"), F.explode(cells).alias("_c"))
        .select("y", "_c.feature", "_c.x")
        .select("y", "feature",
                F.size(F.filter(cuts[F.col("feature")], lambda e: e < F.col("x"))).alias("bin"))
        .groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("n"))
    )
    # Windows over counted cells: of one bin, of one label, of one feature.
    def whole(*by: str) -> Column:
        return F.sum("n").over(Window.partitionBy("feature", *by))

    rows = joint.select("feature", "n", whole("bin").alias("nx"), whole("y").alias("ny"), whole().alias("total"))
    term = F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))
    return rows.groupBy("feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mi"))


def select_by_mi(df: DataFrame, label: str, cols: list[str] | None = None,
                 k: int = KEEP_FEATURES, bins: int = 10, estimate: str = "bins") -> DataFrame:
    """Label, other columns and the ``k`` columns with most information on the label, by ``bins`` or by ``neighbours``."""
    cols = [c for c in (cols or numeric_columns(df)) if c != label]
    if estimate not in ("bins", "neighbours"):
        raise ValueError(f"unknown estimate {estimate!r}")
    found = mutual_information(df, label, cols, bins) if estimate == "bins" else neighbour_information(df, label, cols)
    ranked = found.collect()
    ranked = sorted(ranked, key=lambda r: (-r["mi"], cols.index(r["feature"])))
    gone = set(cols) - {r["feature"] for r in ranked[:k]}
    return df.select([col(c) for c in df.columns if c not in gone])


def select_by_variance(df: DataFrame, cols: list[str] | None = None, k: int = KEEP_FEATURES
                       ) -> DataFrame:
    """Other columns and the ``k`` of highest variance, null as 0."""
    cols = cols or numeric_columns(df)
    gone = set(by_variance(df, cols, fill=0.0)[k:])
    return df.select([col(c) for c in df.columns if c not in gone])


class Projection(NamedTuple):
    table: DataFrame
    model: PipelineModel | None
    explained: list[float]


def pca(df: DataFrame, cols: list[str], n: int = PCA_COMPONENTS, keep: list[str] = ()) -> Projection:
    """Standardized columns on their principal components ``PC1..``; nulls as 0.

    A table of fewer than two rows has no spread and stays as it is. ``ml.PCA`` does
    not centre the data it projects, so the scaler does. The scaler uses the
    sample std; the constant factor to the population std is put on the result.
    The sign of a component is arbitrary.
    """
    filled = df.select(*[col(c) for c in keep],
                       *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    rows = filled.count()
    count = min(n, len(cols), rows)
    if rows < 2 or not cols:
        return Projection(filled.select(*[col(c) for c in cols], *[col(c) for c in keep]), None, [])
    packed = VectorAssembler(inputCols=cols, outputCol="_raw").transform(filled).select(
        *[col(c) for c in keep], "_raw")
    model = Pipeline(stages=[
        StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True),
        PCA(k=count, inputCol="_x", outputCol="_pc"),
    ]).fit(packed)
    parts = vector_to_array(F.col("_pc"))
    to_population = F.lit(math.sqrt(rows / (rows - 1)))
    table = model.transform(packed).select(*[col(c) for c in keep], parts.alias("_pc")).select(
        *[(F.col("_pc")[i] * to_population).alias(f"PC{i + 1}") for i in range(count)],
        *[col(c) for c in keep])
    return Projection(table, model, [float(v) for v in model.stages[-1].explainedVariance])


def unpack_vector(df: DataFrame, column: str, size: int, prefix: str) -> DataFrame:
    """An array column as ``size`` double columns ``prefix0..``."""
    return df.select(*[col(c) for c in df.columns if c != column],
                     *[col(column)[i].cast("double").alias(f"{prefix}{i}") for i in range(size)])


class Reduced(NamedTuple):
    table: DataFrame
    label: str | None
    model: PipelineModel | None
    explained: list[float]


def reduce_features(df: DataFrame, candidates: list[str] = LABEL_CANDIDATES,
                    k: int = KEEP_FEATURES, n: int = PCA_COMPONENTS) -> Reduced:
    """Find the label, drop low variance, select by information or variance, project."""
    label = detect_label(df, candidates)
    cols = [c for c in numeric_columns(df) if c != label]
    table = drop_low_variance(df.select(*[col(c) for c in cols], *([col(label)] if label else [])),
                              cols)
    cols = [c for c in table.columns if c != label]
    if label:
        table = select_by_mi(table, label, cols, k)
    elif len(cols) > k:
        table = select_by_variance(table, cols, k)
    cols = [c for c in table.columns if c != label]
    done = pca(table, cols, n, keep=[label] if label else [])
    return Reduced(done.table, label, done.model, done.explained)
