"""Stays: odd rows, the drivers found, bounded leaves of the second boosted learner."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from medlark.operators import models
from medlark.plans.admissions import forecast_stays


def test_the_drivers_of_a_stay_are_found(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(hours=7 * i), day + dt.timedelta(hours=7 * i, days=2 + 5 * (i % 3)), "abc"[i % 3], i % 7, "w" if i % 2 else "i")
            for i in range(240)] + [(900, None, day, "a", 1, "w"), (901, day, None, "b", None, "i")]
    df = spark.createDataFrame(rows, "id long, a timestamp, b timestamp, kind string, n int, ward string")
    beds = spark.createDataFrame([("w", 1.0, 20.0, 0.5), ("i", 0.3, 2.0, 1.0)], "ward string, demand double, capacity double, factor double")
    found = forecast_stays(df, "a", "b", ["id"], {"kind": "kind_code"}, ["n"], beds, "ward", trees=2, depth=3, splits=3, top=2)
    assert found.features == ["n", "kind_code", "admission_month", "admission_weekday", "is_weekend"]
    folds = found.run.folds.collect()
    assert sorted(r["test_fold"] for r in folds) == [1, 2, 3] and all(r["mae"] < 1e-9 and r["r2"] > 1 - 1e-9 for r in folds)
    top = found.top.collect()
    assert top[0]["feature"] == "kind_code" and abs(top[0]["importance"] - 1) < 1e-9 and len(top) == 2
    load = {r["ward"]: r for r in found.load.collect()}
    assert abs(load["w"]["utilization"] - 0.7) < 1e-9 and load["i"]["state"] == "overload"


def test_admissions_are_read_once(spark):
    """Whatever joins they come from are not repeated for each of the scans that follow."""
    read, day = spark.sparkContext.accumulator(0), dt.datetime(2024, 1, 1)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [(i, day + dt.timedelta(hours=7 * i), day + dt.timedelta(hours=7 * i, days=2 + 5 * (i % 3)), "abc"[i % 3], "w", "x" * 9) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a timestamp, b timestamp, kind string, ward string, more string")
    beds = spark.createDataFrame([("w", 1.0, 20.0, 0.5)], "ward string, demand double, capacity double, factor double")
    found = forecast_stays(df.mapInArrow(counted, df.schema), "a", "b", ["id"], {"kind": "kind_code"}, [], beds, "ward",
                           trees=1, depth=2, splits=2)
    assert found.run.folds.count() == 2 and found.load.count() == 1 and found.top.count() == 4
    assert read.value == 60


def test_second_boosted_learner_has_its_own_grid_and_bounded_leaves(spark):
    est = models.boosted_trees_classifier(["a"], trees=2, depth=6, weight="weight")
    assert len(models.boosted_grid(est, models.WEIGHTED_GRID)) == 36 and len(models.boosted_grid(est)) == 72
    df = models.add_class_weight(spark.range(400).select(
        F.col("id").cast("double").alias("a"), (F.xxhash64("id") % 3 == 0).cast("int").alias("label")))
    for leaves in (3, 5):
        grid = models.boosted_grid(est, {"leaves": [leaves]})
        trees = est.copy(grid[0]).fit(df).stages[-1].trees
        assert all(t.numNodes <= 2 * leaves - 1 for t in trees)
    assert max(t.numNodes for t in est.fit(df).stages[-1].trees) > 9
