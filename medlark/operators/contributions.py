"""What each feature adds to a tree model's score of a row: exact Shapley values along the paths, from the model's node table.

A leaf is reached with certainty on the features a row is known by, and with the share of training rows on its branches
on the others. The Shapley value of such a product is an integral of a polynomial, which a few points give exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.storage import discard, scratch_path
from medlark.functions.types import col, rows_from_struct

#: Rows times leaves that a task works on at once.
_CELLS = 1_000_000


class Leaves(NamedTuple):
    """The leaves of one tree; per leaf and distinct feature of its path the interval ``lo < x <= hi`` and the share of rows in it.

    Shorter paths are filled up with the feature -1, which all rows have.
    """

    value: np.ndarray
    feature: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    share: np.ndarray


def _leaves(nodes: dict[int, tuple], weight: float) -> Leaves:
    """``nodes``: id -> (value, rows, left, right, feature, threshold)."""
    found: list[tuple[float, dict[int, tuple[float, float, float]]]] = []
    todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while todo:
        at, path = todo.pop()
        value, rows, left, right, feature, threshold = nodes[at]
        if left < 0:
            found.append((value * weight, path))
            continue
        lo, hi, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, low, high in ((left, lo, min(hi, threshold)), (right, max(lo, threshold), hi)):
            todo.append((child, {**path, feature: (low, high, share * nodes[child][1] / rows)}))
    depth = max([1, *(len(p) for _, p in found)])
    out = Leaves(np.array([v for v, _ in found]), np.full((len(found), depth), -1), np.full((len(found), depth), -np.inf),
                 np.full((len(found), depth), np.inf), np.ones((len(found), depth)))
    for i, (_, path) in enumerate(found):
        for j, (feature, (lo, hi, share)) in enumerate(path.items()):
            out.feature[i, j], out.lo[i, j], out.hi[i, j], out.share[i, j] = feature, lo, hi, share
    return out


def trees_of(model: PipelineModel) -> list[Leaves]:
    """Leaves of all trees of the last stage, worth what they add to the score.

    The score is the margin of boosted classifiers, the prediction of regressors and the probability of 1 of forest classifiers.
    Nodes come from the model as Spark stores it; they are bounded by the trees and their depth.
    """
    last = model.stages[-1]
    kinds = (GBTClassificationModel, RandomForestClassificationModel, GBTRegressionModel, RandomForestRegressionModel)
    if not isinstance(last, kinds):
        raise ValueError(f"{type(last).__name__} has no trees")
    spark = SparkSession.active()
    path = scratch_path(spark, "model")
    last.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    discard(spark, path)
    votes = isinstance(last, RandomForestClassificationModel)
    mean = votes or isinstance(last, RandomForestRegressionModel)
    nodes: dict[int, dict[int, tuple]] = {}
    for r in rows:
        if r["split"]["numCategories"] > 0:
            raise ValueError("a split by categories has no interval")
        value = r["impurityStats"][1] / sum(r["impurityStats"]) if votes else r["prediction"]
        threshold = (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0]
        nodes.setdefault(r["treeID"], {})[r["id"]] = (
            value, r["rawCount"], r["leftChild"], r["rightChild"], r["split"]["featureIndex"], threshold)
    return [_leaves(nodes[t], 1 / len(nodes) if mean else last.treeWeights[t]) for t in sorted(nodes)]


def _contributions(x: np.ndarray, trees: list[Leaves], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(contribution by row and feature, score by row)."""
    out, score = np.zeros((len(x), width + 1)), np.zeros(len(x))
    # A column for the feature -1, which every interval has.
    x = np.column_stack([x, np.zeros(len(x))])
    for t in trees:
        depth = t.feature.shape[1]
        points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
        points, weights = (points + 1) / 2, weights / 2
        to_feature = np.zeros((t.feature.size, width + 1))
        to_feature[np.arange(t.feature.size), t.feature.ravel()] = 1.0
        step = max(1, _CELLS // t.feature.size)
        for start in range(0, len(x), step):
            part = x[start:start + step][:, t.feature]
            inside = ((part > t.lo) & (part <= t.hi)).astype(float)
            total = np.zeros_like(inside)
            for p, w in zip(points, weights):
                each = t.share * (1 - p) + inside * p
                total += w * each.prod(axis=2, keepdims=True) / each
            total *= (inside - t.share) * t.value[:, None]
            out[start:start + step] += total.reshape(len(part), -1) @ to_feature
            score[start:start + step] += inside.prod(axis=2) @ t.value
    return out[:, :width], score


def base_of(trees: list[Leaves]) -> float:
    """The score of a row of which nothing is known: that of all training rows."""
    return float(sum((t.value * t.share.prod(axis=1)).sum() for t in trees))


def tree_contributions(model: PipelineModel, df: DataFrame, features: list[str], key: list[str]) -> DataFrame:
    """The key columns, ``phi_<feature>`` per feature, ``base`` and ``tree_score``, their sum on every row.

    Null and NaN features are 0, as in the model plans.
    """
    trees = trees_of(model)
    base = base_of(trees)
    names = [*[f"phi_{f}" for f in features], "base", "tree_score"]
    inputs = [F.coalesce(F.nanvl(col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_x{i}") for i, f in enumerate(features)]
    narrow = df.select(*[col(k) for k in key], *inputs)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[len(key):]])
            phi, score = _contributions(x, trees, len(features))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(key)], *map(pa.array, np.ascontiguousarray(phi.T)), pa.array(np.full(len(x), base)), pa.array(score)],
                names=[*batch.schema.names[:len(key)], *names])

    schema = T.StructType([*[df.schema[k] for k in key], *[T.StructField(n, T.DoubleType()) for n in names]])
    return narrow.mapInArrow(explain, schema)


def contribution_importance(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance): mean absolute contribution over all rows."""
    each = tree_contributions(model, df, features, [])
    one = each.agg(*[F.avg(F.abs(col(f"phi_{f}"))).alias(f"i{i}") for i, f in enumerate(features)])
    return rows_from_struct(one, [
        F.struct(F.lit(f).alias("feature"), F.col(f"i{i}").alias("importance")) for i, f in enumerate(features)])
