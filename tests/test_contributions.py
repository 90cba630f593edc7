"""Contributions of tree models against the definition, and their sum against the score."""

from __future__ import annotations

from itertools import combinations
from math import exp, factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from medlark.operators import contributions, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 6, (400, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 2) + rng.normal(0, 0.5, 400) > 5).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v), float(v + r[3] / 10)) for i, (r, v) in enumerate(zip(x, y))],
                               "id int, a double, b double, c double, d double, label int, amount double")
    return df.repartition(3, "id")


FEATURES = ["a", "b", "c", "d"]


def by_definition(trees, x, width):
    """Shapley values of the game that walks down known features and averages over unknown ones, subset by subset."""
    def worth(known):
        total = 0.0
        for t in trees:
            for leaf in range(len(t.value)):
                p = 1.0
                for f, lo, hi, share in zip(t.feature[leaf], t.lo[leaf], t.hi[leaf], t.share[leaf]):
                    if f >= 0:
                        p *= (lo < x[f] <= hi) if f in known else share
                total += t.value[leaf] * p
        return total

    out = np.zeros(width)
    for f in range(width):
        rest = [g for g in range(width) if g != f]
        for n in range(width):
            for some in combinations(rest, n):
                weight = factorial(n) * factorial(width - n - 1) / factorial(width)
                out[f] += weight * (worth({*some, f}) - worth(set(some)))
    return out


@pytest.mark.parametrize("kind", ["boosted", "forest", "regressor"])
def test_contributions_are_shapley_values_and_add_up(rows, kind):
    plan = {"boosted": models.boosted_trees_classifier(FEATURES, trees=4, depth=4),
            "forest": models.random_forest_classifier(FEATURES, trees=5, depth=5, columns="all"),
            "regressor": models.boosted_trees_regressor(FEATURES, label="amount", trees=4, depth=5)}[kind]
    fitted = plan.fit(rows)
    got = contributions.tree_contributions(fitted, rows, FEATURES, ["id"]).orderBy("id").collect()
    scored = fitted.transform(rows) if kind == "regressor" else models.score(fitted, rows)
    want = {r["id"]: r["prediction" if kind == "regressor" else "score"] for r in scored.collect()}
    assert len(got) == 400
    trees = contributions.trees_of(fitted)
    cells = {r["id"]: [r[f] for f in FEATURES] for r in rows.collect()}
    for r in got:
        total = r["base"] + sum(r[f"phi_{f}"] for f in FEATURES)
        assert total == pytest.approx(r["tree_score"], abs=1e-9)
        assert want[r["id"]] == pytest.approx(1 / (1 + exp(-2 * total)) if kind == "boosted" else total, abs=1e-9)
    for r in got[:12]:
        assert [r[f"phi_{f}"] for f in FEATURES] == pytest.approx(by_definition(trees, cells[r["id"]], 4).tolist(), abs=1e-9)
    ranked = contributions.contribution_importance(fitted, rows, FEATURES).collect()
    assert {r["feature"] for r in ranked} == set(FEATURES) and all(r["importance"] >= 0 for r in ranked)


def test_models_without_trees_have_no_contributions(rows):
    fitted = models.balanced_logistic(FEATURES, weight="w").fit(rows.withColumn("w", F.lit(1.0)))
    with pytest.raises(ValueError):
        contributions.tree_contributions(fitted, rows, FEATURES, ["id"])


def test_null_features_and_no_rows(rows):
    fitted = models.boosted_trees_regressor(FEATURES, label="amount", trees=2, depth=2).fit(rows)
    odd = rows.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(float("nan")))
    zero = rows.withColumn("a", F.lit(0.0)).withColumn("b", F.lit(0.0))
    assert contributions.tree_contributions(fitted, odd, FEATURES, ["id"]).exceptAll(
        contributions.tree_contributions(fitted, zero, FEATURES, ["id"])).count() == 0
    assert contributions.tree_contributions(fitted, rows.limit(0), FEATURES, ["id"]).collect() == []
