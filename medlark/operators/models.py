"""Risk and length-of-stay models on Spark ML, with their splits and metrics."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medlark.functions.hashing import keyed_uniform
from medlark.functions.quantiles import exact_quantiles, order_statistics
from medlark.functions.ranking import ROWS_PER_BUCKET, running_totals
from medlark.functions.types import col, micros, rows_from_struct

# Fixed values of the model runs.
TEST_SHARE = 0.2
FOLDS = 5
SALT = "42"
VOTE_AT = 0.5
MAX_CLASSES = 100
BOOSTED_GRID = {
    "trees": [100, 200], "depth": [3, 5, 7], "rate": [0.01, 0.05, 0.1],
    "rows": [0.8, 1.0], "columns": [0.8, 1.0],
}
WEIGHTED_GRID = {
    "trees": [100, 200], "depth": [3, 5, 7], "rate": [0.01, 0.05, 0.1], "leaves": [15, 31],
}
EPS = 2.220446049250313e-16


# --- splits -------------------------------------------------------------------

def _class_cutoffs(df: DataFrame, label: str, u: Column, probs: list[float]) -> dict:
    """Quantiles of the keyed draw within each class. Classes are few and checked to be."""
    classes = [r[0] for r in df.select(col(label)).where(col(label).isNotNull())
               .distinct().limit(MAX_CLASSES + 1).collect()]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    cuts = exact_quantiles(
        df, {str(i): F.when(col(label) == F.lit(c), u) for i, c in enumerate(classes)}, probs)
    return {c: cuts[str(i)] for i, c in enumerate(classes)}


def stratified_split(df: DataFrame, label: str, key: list[str], test: float = TEST_SHARE,
                     salt: str = SALT) -> DataFrame:
    """Add ``is_test``: the share ``test`` of each class with the lowest keyed draws."""
    u = keyed_uniform(*[col(k) for k in key], salt=salt)
    expr = F.lit(0)
    for value, (cut,) in _class_cutoffs(df, label, u, [test]).items():
        expr = F.when(col(label) == F.lit(value), (u <= F.lit(cut)).cast("int")).otherwise(expr)
    return df.withColumn("is_test", expr)


def stratified_folds(df: DataFrame, label: str, key: list[str], folds: int = FOLDS,
                     salt: str = SALT) -> DataFrame:
    """Add ``fold`` 0.. of equal size within each class, in keyed-draw order."""
    u = keyed_uniform(*[col(k) for k in key], salt=salt)
    expr = F.lit(0)
    probs = [i / folds for i in range(1, folds)]
    for value, cuts in _class_cutoffs(df, label, u, probs).items():
        at = F.lit(0)
        for cut in cuts:
            at = at + (u > F.lit(cut)).cast("int")
        expr = F.when(col(label) == F.lit(value), at).otherwise(expr)
    return df.withColumn("fold", expr)


def expanding_folds(df: DataFrame, order: str, key: list[str], splits: int = FOLDS,
                    salt: str = SALT) -> DataFrame:
    """Add ``test_fold``: 1.. for the test blocks in time order, 0 for rows before them.

    A test block has ``n // (splits + 1)`` rows; fold f trains on rows with a
    lower number. Equal times go by the keyed draw; rows without a time are never tested (0). The block borders are found
    as order statistics, so no row moves and nothing is ranked.
    """
    when = micros(df, order)
    u = keyed_uniform(*[col(k) for k in key], salt=salt)
    n = df.where(col(order).isNotNull()).count()
    size = n // (splits + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {splits} folds")
    ranks = [n - (splits - f) * size for f in range(splits)]
    times = order_statistics(df, {"t": when}, {"t": ranks}, {"t": n})["t"]
    counts = df.agg(*[e for i, t in enumerate(times) for e in (
        F.count_if(when < t).alias(f"b{i}"), F.count_if(when == t).alias(f"t{i}"))]).first()
    # Where a border falls among rows of equal time, the draw decides.
    inner = {str(i): r - counts[f"b{i}"] for i, r in enumerate(ranks) if r > counts[f"b{i}"]}
    tied = df.where(when.isin([times[int(i)] for i in inner])) if inner else df
    draws = order_statistics(
        tied, {i: F.when(when == F.lit(times[int(i)]), u) for i in inner},
        {i: [r] for i, r in inner.items()}, {i: counts[f"t{i}"] for i in inner})
    fold = F.lit(0)
    for i, t in enumerate(times):
        past = when > F.lit(t)
        if str(i) in draws:
            past = past | ((when == F.lit(t)) & (u >= F.lit(draws[str(i)][0])))
        else:
            past = when >= F.lit(t)
        fold = fold + F.coalesce(past, F.lit(False)).cast("int")
    return df.withColumn("test_fold", fold)


# --- estimators ---------------------------------------------------------------

def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error")


def boosted_trees_classifier(features: list[str], label: str = "label", trees: int = 100,
                             depth: int = 5, rate: float = 0.1, rows: float = 1.0,
                             columns: str = "all", weight: str | None = None) -> Pipeline:
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth,
                        stepSize=rate, subsamplingRate=rows, featureSubsetStrategy=columns, seed=42)
    if weight:
        gbt.setWeightCol(weight)
    return Pipeline(stages=[assembler(features), gbt])


def boosted_grid(estimator: Pipeline, values: dict[str, list] = BOOSTED_GRID) -> list[dict]:
    """All combinations of the given settings for :func:`grid_search`, 72 by default, 36 of WEIGHTED_GRID.

    ``leaves`` bounds the leaves of a tree: each must hold one part in so many of the weight.
    """
    gbt = estimator.getStages()[-1]
    params = {"trees": gbt.maxIter, "depth": gbt.maxDepth, "rate": gbt.stepSize,
              "rows": gbt.subsamplingRate, "columns": gbt.featureSubsetStrategy,
              "leaves": gbt.minWeightFractionPerNode}
    grid = ParamGridBuilder()
    for name, options in values.items():
        if name == "columns":
            options = list(map(str, options))
        elif name == "leaves":
            options = [1.0 / n for n in options]
        grid = grid.addGrid(params[name], options)
    return grid.build()


def random_forest_classifier(features: list[str], label: str = "label", trees: int = 200,
                             depth: int = 10, columns: str = "auto") -> Pipeline:
    return Pipeline(stages=[assembler(features), RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=42,
        featureSubsetStrategy=columns)])


def class_weights(df: DataFrame, label: str = "label") -> dict:
    """``n / (classes * n_class)`` per class."""
    rows = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    counts = {r[label]: r["n"] for r in rows}
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def add_class_weight(df: DataFrame, label: str = "label", into: str = "weight") -> DataFrame:
    expr = F.lit(1.0)
    for value, w in class_weights(df, label).items():
        expr = F.when(col(label) == F.lit(value), F.lit(w)).otherwise(expr)
    return df.withColumn(into, expr)


def balanced_logistic(features: list[str], label: str = "label", weight: str = "weight",
                      ridge: float = 0.0, rounds: int = 200) -> Pipeline:
    """Standardize and fit on rows weighted by :func:`add_class_weight`.

    The scaler is part of the model, so a test table is scaled by the training
    table's mean and std.
    """
    return Pipeline(stages=[
        assembler(features, "raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(labelCol=label, featuresCol="features", weightCol=weight,
                           regParam=ridge, maxIter=rounds, standardization=False),
    ])


def boosted_trees_regressor(features: list[str], label: str = "label", trees: int = 200,
                            depth: int = 6, rate: float = 0.05) -> Pipeline:
    return Pipeline(stages=[assembler(features), GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate,
        seed=42)])


def grid_search(estimator: Estimator, grid: list[dict], df: DataFrame, label: str = "label",
                folds: int = FOLDS, fold_col: str = "fold", parallelism: int = 4
                ) -> CrossValidatorModel:
    """Best of ``grid`` by mean area under the ROC curve over the folds in ``fold_col``."""
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, numFolds=folds, foldCol=fold_col,
        evaluator=BinaryClassificationEvaluator(labelCol=label), parallelism=parallelism,
    ).fit(df)


def score(model: Transformer, df: DataFrame, into: str = "score") -> DataFrame:
    """The table with the class-1 probability; the model's own columns are dropped."""
    done = model.transform(df)
    return done.select(*[col(c) for c in df.columns],
                       vector_to_array(F.col("probability"))[1].alias(into))


def vote(df: DataFrame, scores: list[str], at: float = VOTE_AT) -> DataFrame:
    """Add ``vote_score``, the mean of the scores, and ``vote`` (1 from ``at`` on)."""
    total = sum((col(s) for s in scores[1:]), col(scores[0]))
    mean = total / F.lit(float(len(scores)))
    return df.select("*", mean.alias("vote_score"), (mean >= F.lit(at)).cast("int").alias("vote"))


def soft_vote(models: dict[str, Transformer], df: DataFrame, at: float = VOTE_AT) -> DataFrame:
    """Score with every model (``score_<name>``) and vote."""
    out = df
    for name, m in models.items():
        out = score(m, out, into=f"score_{name}")
    return vote(out, [f"score_{n}" for n in models], at)


# --- metrics ------------------------------------------------------------------

def _score_steps(scored: DataFrame, label: str, scores: list[str], rows_per_bucket: int) -> DataFrame:
    """One row per score column, by number, and distinct score: ones and zeros at it and up to it."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), col(s).cast("double").alias("threshold")) for i, s in enumerate(scores)])
    steps = (
        scored.where(col(label).isNotNull()).select((col(label) == 1).alias("_one"), F.inline(cells))
        .where(F.col("threshold").isNotNull()).groupBy("i", "threshold")
        .agg(F.count_if("_one").alias("pos"), F.count_if(~F.col("_one")).alias("neg"))
    )
    return running_totals(steps, "threshold", {"cum_pos": "pos", "cum_neg": "neg"},
                          rows_per_bucket=rows_per_bucket, group="i")


def metrics_of_scores(scored: DataFrame, scores: list[str], label: str = "label", at: float = VOTE_AT,
                      rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(model, n_rows, auc, f1, precision, recall) per score column, all ranked together; AUC is exact, ties count half."""
    steps = _score_steps(scored, label, scores, rows_per_bucket)
    hit = F.col("threshold") >= F.lit(at)
    one = steps.groupBy("i").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)).alias("wins"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"))
    zero = F.lit(0.0)
    every = scored.sparkSession.range(len(scores)).select(F.col("id").cast("int").alias("i"))
    return every.join(one, "i", "left").select(
        F.get(F.array(*map(F.lit, scores)), F.col("i")).alias("model"),
        (F.col("p") + F.col("n")).alias("n_rows"),
        F.try_divide(F.col("wins"), F.col("p").cast("double") * F.col("n")).alias("auc"),
        F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.col("p") + F.col("tp") + F.col("fp")),
                   zero).alias("f1"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), zero
                   ).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("p")), zero).alias("recall"))


def binary_metrics(scored: DataFrame, label: str = "label", score_col: str = "score",
                   at: float = VOTE_AT, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row: rows, exact AUC with ties as halves, F1, precision and recall at ``at``."""
    return metrics_of_scores(scored, [score_col], label, at, rows_per_bucket).drop("model")


def roc_points(scored: DataFrame, label: str = "label", score_col: str = "score",
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(threshold, fpr, tpr) with every distinct score as threshold; the curve starts at 0, 0."""
    steps = _score_steps(scored, label, [score_col], rows_per_bucket)
    total = scored.where(col(score_col).isNotNull() & col(label).isNotNull()).agg(
        F.count_if(col(label) == 1).alias("p"), F.count_if(col(label) != 1).alias("n")).first()

    def share(cum: str, own: str, all_: int) -> Column:
        return F.try_divide(F.lit(float(all_)) - F.col(cum) + F.col(own), F.lit(float(all_)))

    return steps.select("threshold", share("cum_neg", "neg", total["n"]).alias("fpr"),
                        share("cum_pos", "pos", total["p"]).alias("tpr"))


def best_model(metrics: DataFrame, by: str = "auc") -> DataFrame:
    """The row of the highest metric; equal ones in name order."""
    return metrics.where(col(by).isNotNull()).agg(
        F.min(F.struct((-col(by)).alias("_k"), *[col(c) for c in ["model", *[
            c for c in metrics.columns if c != "model"]]])).alias("_best")
    ).select("_best.*").drop("_k")


def regression_metrics(scored: DataFrame, y: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """Rows, MAE, MAPE and R2, per group of ``by``."""
    a, p = col(y).cast("double"), col(prediction).cast("double")
    miss = F.abs(a - p)
    return scored.where(a.isNotNull() & p.isNotNull()).groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(miss).alias("mae"),
        F.avg(miss / F.greatest(F.abs(a), F.lit(EPS))).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.avg(miss * miss), F.var_pop(a))).alias("r2"))


# --- importance ---------------------------------------------------------------

def linear_importance(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(feature, importance): mean of abs(w (x - mean x)), the exact mean contribution."""
    cols = list(weights)
    means = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    one = df.agg(*[
        F.avg(F.abs(F.lit(float(weights[c])) * (col(c) - F.lit(means[f"m{i}"])))).alias(f"i{i}")
        for i, c in enumerate(cols)])
    return rows_from_struct(one, [
        F.struct(F.lit(c).alias("feature"), F.col(f"i{i}").alias("importance"))
        for i, c in enumerate(cols)])


def shuffle_importance(model: Transformer, df: DataFrame, features: list[str], key: list[str],
                       salt: str = SALT, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(feature, importance): mean change of the score when one column is passed on a row.

    Works for any scorer, on all rows: inside equal ranges of a keyed draw each row takes the next
    row's value of the column, the last one the first's.
    """
    drawn = df.select(*[col(c) for c in dict.fromkeys([*key, *features])]).withColumn(
        "_u", keyed_uniform(*[col(c) for c in key], salt=salt))
    buckets = drawn.count() // rows_per_bucket + 1
    cut = drawn.withColumn("_bucket", F.floor(F.col("_u") * buckets))
    order = Window.partitionBy("_bucket").orderBy("_u", *[col(c) for c in key])
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = cut.select(
        *[col(c) for c in features],
        *[F.when(F.row_number().over(order) < F.count(F.lit(1)).over(whole), F.lead(col(c)).over(order))
          .otherwise(F.first(col(c)).over(whole)).alias(f"_next{i}") for i, c in enumerate(features)])
    moved = moved.withColumn("_row", F.monotonically_increasing_id())
    versions = [F.struct(F.lit("").alias("feature"), *[col(c).alias(c) for c in features])]
    for i, c in enumerate(features):
        versions.append(F.struct(F.lit(c).alias("feature"), *[
            (F.col(f"_next{i}") if o == c else col(o)).alias(o) for o in features]))
    rows = moved.select("_row", F.explode(F.array(*versions)).alias("_v")).select("_row", "_v.*")
    scored = score(model, rows).select("_row", "feature", "score")
    base = F.max(F.when(F.col("feature") == "", F.col("score"))).over(Window.partitionBy("_row"))
    return (
        scored.withColumn("_change", F.abs(F.col("score") - base)).where(F.col("feature") != "")
        .groupBy("feature").agg(F.avg("_change").alias("importance"))
    )


def feature_importance(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance): contributions of a linear model, split gains of a tree model."""
    last = model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        scaler = model.stages[-2]
        weights = {c: float(w) / s if s else 0.0
                   for c, w, s in zip(features, last.coefficients, scaler.std)}
        return linear_importance(df, weights)
    gains = [float(g) for g in last.featureImportances.toArray()]
    return df.sparkSession.createDataFrame(list(zip(features, gains)), "feature string, importance double")


# --- use ----------------------------------------------------------------------

class External(NamedTuple):
    scored: DataFrame
    summary: DataFrame


def score_external(model: Transformer, df: DataFrame, features: list[str],
                   names: dict[str, str] | None = None, at: float = VOTE_AT) -> External:
    """Score another table; ``names`` maps a feature to the column that holds it there.

    A feature with no column is an error, not a column of zeros.
    """
    names = names or {}
    missing = [f for f in features if names.get(f, f) not in df.columns]
    if missing:
        raise ValueError(f"no column for the features {missing}")
    own = [c for c in df.columns if c not in features]
    table = df.select(*[col(c) for c in own], *[
        F.coalesce(col(names.get(f, f)).cast("double"), F.lit(0.0)).alias(f) for f in features])
    scored = score(model, table)
    summary = scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") > at).alias("n_high"),
        F.avg((F.col("score") > at).cast("double")).alias("high_share"))
    return External(scored, summary)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
