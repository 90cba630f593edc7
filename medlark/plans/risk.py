"""Labelled table to compared risk models; admissions to a length-of-stay model."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.operators import models


class RiskRun(NamedTuple):
    models: dict[str, PipelineModel]
    scored: DataFrame
    metrics: DataFrame
    best: str


def _searched(estimator: Pipeline, values: dict[str, list], train: DataFrame, folds: int) -> Pipeline:
    """The estimator with the best of the settings; a single one needs no folds."""
    grid = models.boosted_grid(estimator, values)
    if len(grid) == 1:
        return estimator.copy(grid[0])
    means = models.grid_search(estimator, grid, train, folds=folds).avgMetrics
    return estimator.copy(grid[max(range(len(grid)), key=lambda i: means[i])])


def train_risk_models(
    df: DataFrame, features: list[str], label: str, key: list[str], grid: dict[str, list] = models.BOOSTED_GRID,
    weighted_grid: dict[str, list] = models.WEIGHTED_GRID, forest_trees: int = 200, forest_depth: int = 10,
    folds: int = models.FOLDS,
) -> RiskRun:
    """Split, search two boosted learners on folds, fit forest and logistic, vote, compare.

    The second boosted learner weighs the labels alike and bounds the leaves of a tree; each has a grid of its
    own, 72 and 36 settings by default. The best model is the one with the highest AUC on a validation fold of the
    training rows; the test rows are for the reported metrics only.
    """
    ready = df.select(*[col(k) for k in key], col(label).cast("int").alias("label"), *[
        F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    split = models.stratified_split(ready, "label", key)
    # Fitting reads the rows many times: store them once, numbered by fold.
    stored = cut_lineage(models.add_class_weight(
        models.stratified_folds(split, "label", key, folds)))
    train, test = stored.where("is_test = 0"), stored.where("is_test = 1")
    fit_on, check_on = train.where("fold > 0"), train.where("fold = 0")

    plans = {
        "boosted_trees": _searched(models.boosted_trees_classifier(features), grid, train, folds),
        "boosted_weighted": _searched(models.boosted_trees_classifier(features, weight="weight"), weighted_grid, train, folds),
        "random_forest": models.random_forest_classifier(features, trees=forest_trees,
                                                         depth=forest_depth),
        "logistic": models.balanced_logistic(features),
    }
    check = {n: p.fit(fit_on) for n, p in plans.items()}
    found = {r["model"]: r["auc"] or 0.0 for r in _metrics(models.soft_vote(check, check_on), check).collect()}
    best = max([*check, "vote"], key=lambda n: found[n])
    fitted = {n: p.fit(train) for n, p in plans.items()}
    scored = models.soft_vote(fitted, test)
    return RiskRun(fitted, scored, _metrics(scored, fitted), best)


def _metrics(scored: DataFrame, fitted: dict) -> DataFrame:
    """Metrics of every model and of their vote; the scores are worked out once and stored."""
    columns = {f"score_{n}": n for n in fitted} | {"vote_score": "vote"}
    stored = cut_lineage(scored.select("label", *columns))
    return models.metrics_of_scores(stored, list(columns)).replace(columns, subset=["model"])


class StayRun(NamedTuple):
    model: PipelineModel
    folds: DataFrame
    importance: DataFrame


def train_stay_model(
    df: DataFrame, features: list[str], target: str, order: str, key: list[str],
    trees: int = 200, depth: int = 6, rate: float = 0.05, splits: int = models.FOLDS,
) -> StayRun:
    """Expanding folds in time order, metrics per fold, then a model on all rows."""
    ready = df.select(*[col(k) for k in key], col(order), col(target).cast("double").alias("label"), *[
        F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    # Keys and times have done their part once the folds are known.
    stored = cut_lineage(models.expanding_folds(ready, order, key, splits).select("label", *[col(c) for c in features], "test_fold"))
    plan = models.boosted_trees_regressor(features, trees=trees, depth=depth, rate=rate)
    parts = []
    for f in range(1, splits + 1):
        fold_model = plan.fit(stored.where(F.col("test_fold") < f))
        parts.append(models.regression_metrics(
            fold_model.transform(stored.where(F.col("test_fold") == f)),
            "label", "prediction", ["test_fold"]))
    final = plan.fit(stored)
    return StayRun(final, reduce(DataFrame.unionByName, parts),
                   models.feature_importance(final, stored, features))
