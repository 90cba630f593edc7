"""The tables behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.types import col

# Fixed values of the report rules.
GOOD_AUC = 0.80
BAND_EDGES = [0.5, 0.7, 0.8, 0.85, 1.0]
BAND_NAMES = ["poor", "fair", "good", "very good"]
HIGH_LOAD, OVERLOAD = 0.7, 0.85


def model_scorecard(metrics: DataFrame) -> DataFrame:
    """(model, auc, f1, n_rows, verdict): ``good`` above an AUC of 0.80."""
    return metrics.select(
        "model", "auc", "f1", "n_rows",
        F.when(F.col("auc") > GOOD_AUC, "good").otherwise("improve").alias("verdict"))


def risk_bands(df: DataFrame, column: str, edges: list[float] = BAND_EDGES,
               names: list[str] = BAND_NAMES) -> DataFrame:
    """Add ``band``: left-closed, the last one closed, ``outside`` beyond the edges."""
    c = col(column)
    band = None
    for i, name in enumerate(names):
        top = c <= edges[i + 1] if i == len(names) - 1 else c < edges[i + 1]
        hit = (c >= edges[i]) & top
        band = F.when(hit, name) if band is None else band.when(hit, name)
    return df.withColumn("band", F.when(c.isNotNull(), band.otherwise("outside")))


def utilization(load: DataFrame, capacity: DataFrame, resource: str, value: str) -> DataFrame:
    """Mean load over capacity, at most 1, per resource: ``overload``, ``high`` or ``normal``.

    ``capacity`` has (resource, demand, capacity, factor): the share of the load
    that asks for the resource and its usable units. It is a ratio, not a queue.
    """
    mean = load.groupBy(col(resource)).agg(F.avg(col(value)).alias("mean_load"))
    share = F.least(F.try_divide(F.col("mean_load") * F.col("demand"),
                                 F.col("capacity") * F.col("factor")), F.lit(1.0))
    return mean.join(capacity, resource).select(
        resource, "mean_load", share.alias("utilization"),
        F.when(share > OVERLOAD, "overload").when(share > HIGH_LOAD, "high").otherwise("normal")
        .alias("state"))


def region_vs_mean(df: DataFrame, region: str, risk: str) -> DataFrame:
    """Mean per region beside the mean of the regions."""
    per = df.groupBy(col(region)).agg(F.avg(col(risk)).alias("risk"))
    mean = per.agg(F.avg("risk").alias("m")).first()["m"]
    return per.select(
        region, "risk", F.lit(mean).alias("overall_mean"),
        (F.col("risk") - F.lit(mean)).alias("difference"))


def headline_figures(audit: DataFrame, metrics: DataFrame, series: DataFrame,
                     external: DataFrame) -> DataFrame:
    """(kpi, value): best AUC, training rows, series points, validation rows."""
    return (
        metrics.agg(F.lit("best_auc").alias("kpi"), F.max("auc").alias("value"))
        .unionByName(audit.agg(F.lit("training_rows").alias("kpi"),
                               F.sum("rows_after").cast("double").alias("value")))
        .unionByName(series.agg(F.lit("series_points").alias("kpi"),
                                F.count(F.lit(1)).cast("double").alias("value")))
        .unionByName(external.agg(F.lit("validation_rows").alias("kpi"),
                                  F.count(F.lit(1)).cast("double").alias("value")))
    )
