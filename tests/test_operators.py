"""Edge cases and properties of the operators on small hand-made tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medlark.functions import neighbours, quantiles
from medlark.functions.storage import scratch_path
from medlark.operators import (
    clean, columns, combine, features, models, privacy, profile, reports, sampling, series,
)
from medlark.plans import cleaning as cleaning_plan
from medlark.plans.cleaning import clean_tables
from medlark.plans.fusion import combine as combine_plan
from medlark.plans.fusion import fuse, fuse_to
from medlark.plans.protection import protect_table, protect_tables
from medlark.plans.trends import series_alerts, series_forecast
from medlark.sources import readers, tree, writers


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(df.columns[0]).collect()]


# --- sources ------------------------------------------------------------------

@pytest.mark.parametrize("line, sep", [
    ("a;b;c", ";"), ("a,b", ","), ("a\tb\tc,d", "\t"), ("a;b,c", ","), ("abc", ","), ("a;b\tc", "\t"),
])
def test_sniff_separator(line, sep):
    assert readers.sniff_separator(line) == sep


def test_latin_text_is_read_as_latin(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name;n\nJosé;1\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("﻿name;n\nJosé;1\n".encode("utf-8"))
    for f, enc in (("a.csv", "ISO-8859-1"), ("b.csv", "UTF-8")):
        path = str(tmp_path / f)
        assert readers.sniff_encoding(spark, path) == enc
        df = readers.read_delimited(spark, path)
        assert df.columns == ["name", "n"] and values(df, "name", "n") == [("José", 1)]


@pytest.mark.parametrize("text, want", [
    ('{"value": [{"a": {"b": 1}}, {"a": {"b": 2}}]}', [(1,), (2,)]),
    ('[{"a": {"b": 1}}, {"a": {"b": 2}}]', [(1,), (2,)]),
    ('{"a": {"b": 5}}', [(5,)]),
])
def test_json_records(spark, tmp_path, text, want):
    (tmp_path / "r.json").write_text(text)
    df = readers.read_json_records(spark, str(tmp_path / "r.json"))
    assert df.columns == ["a.b"] and sorted(tuple(r) for r in df.collect()) == want


@pytest.mark.parametrize("lines", [False, True])
def test_records_with_an_array_called_value(spark, tmp_path, lines):
    rows = ['{"id": 1, "value": [1, 2]}', '{"id": 2, "value": []}']
    (tmp_path / "r.json").write_text("\n".join(rows) if lines else f"[{', '.join(rows)}]")
    df = readers.read_json_records(spark, str(tmp_path / "r.json"), multiline=not lines)
    assert sorted((r["id"], r["value"]) for r in df.collect()) == [(1, [1, 2]), (2, [])]


def test_scan_tree_keeps_a_folder_named_like_the_root(spark, tmp_path):
    root = tmp_path / "data"
    (root / "data").mkdir(parents=True)
    for p in (root / "a.csv", root / "data" / "a.csv"):
        p.write_text("1\n")
    df = readers.scan_tree(spark, str(root), fmt="csv", schema="x int")
    assert {r["table_name"] for r in df.collect()} == {"a", "data__a"}


def test_scan_tree_skips_and_names(spark, tmp_path):
    for p in ("top.csv", "heart/one.csv", "__MACOSX/one.csv", "heart/run.log"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("1\n2\n")
    df = readers.scan_tree(spark, str(tmp_path), fmt="csv", schema="x int")
    assert {r[0]: r[1] for r in df.groupBy("table_name").count().collect()} == {
        "top": 2, "heart__one": 2}


def test_nan_is_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(path)
    assert readers.read_parquet(spark, path).where("x is null").count() == 1


def test_audit_is_appended(spark):
    path = scratch_path(spark, "audit")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    writers.append_audit(spark, path, [writers.audit_row(df, "t", "r1")])
    writers.append_audit(spark, path, [dict(run="r2", table_name="u", status="failed", reason="x")])
    rows = {r["table_name"]: r for r in spark.read.parquet(path).collect()}
    assert (rows["t"]["rows_after"], rows["t"]["duplicates"], rows["t"]["missing_rate"]) == (3, 1, 0.3333)
    assert rows["u"]["status"] == "failed"


# --- columns ------------------------------------------------------------------

def test_names_that_collide_are_an_error(spark):
    with pytest.raises(ValueError):
        columns.normalize_names(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_a_share_of_exactly_the_limit_stays(spark):
    df = spark.range(10).select(
        F.when(F.col("id") >= 4, 1).alias("at"), F.when(F.col("id") >= 5, 1).alias("over"))
    assert columns.drop_sparse_columns(df).columns == ["at"]


def test_boolean_is_not_numeric(spark):
    df = spark.createDataFrame([(True, 1, "a", 1.5)], "b boolean, i int, s string, d double")
    assert columns.split_columns_by_type(df) == (["i", "d"], ["b", "s"])


def test_contains_is_false_for_null_and_takes_text_as_it_is(spark):
    df = spark.createDataFrame([("China (a)",), (None,), ("Chile",), ("SOUTH CHINA",)], "c string")
    assert columns.filter_contains(df, "c", "china").count() == 2
    assert columns.filter_contains(df, "c", "(A)").count() == 1


def test_word_matching():
    assert columns.name_matches("ap_hi", ["ap_hi"]) and columns.name_matches("ap_hi", ["ap_hi"], "substring")
    assert not columns.name_matches("dosage", ["age"]) and columns.name_matches("dosage", ["age"], "substring")


def test_zero_height_gives_null(spark):
    df = spark.createDataFrame([(70.0, 175.0, 120, 80), (70.0, 0.0, 120, 80)],
                               "weight double, height double, ap_hi int, ap_lo int")
    bmi = [r["bmi"] for r in columns.body_measures(df).collect()]
    assert bmi[0] == pytest.approx(22.857142857) and bmi[1] is None


def test_stay_days_are_whole_days(spark):
    df = spark.sql("""SELECT timestamp_ntz'2024-01-06 18:00:00' a, timestamp_ntz'2024-01-07 17:00:00' b
                      UNION ALL SELECT timestamp_ntz'2024-01-08 00:00:00', timestamp_ntz'2024-01-06 12:00:00'""")
    got = sorted(values(columns.stay_features(df, "a", "b"), "los_days", "admission_weekday", "is_weekend"))
    assert got == [(-2, 0, 0), (0, 5, 1)]


def test_label_needs_2_to_10_values(spark):
    df = spark.range(1000).select(
        F.lit(1).alias("outcome"), (F.col("id") % 11).alias("target"), (F.col("id") % 10).alias("cardio"),
        (F.col("id") % 2).alias("stroke"))
    assert columns.detect_label(df) == "cardio"
    assert columns.detect_label(df.select("outcome", "target")) is None


def test_align_keeps_nulls(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert [tuple(r) for r in columns.align_schema(df, ["b", "a", "c"]).collect()] == [(1, None, 0)]


# --- combining ----------------------------------------------------------------

def test_survey_cycles_are_stacked_before_parts_are_joined(spark):
    t = {"BMX_H": spark.createDataFrame([(1, 10)], "SEQN int, w int"),
         "BMX_J": spark.createDataFrame([(2, 20)], "seqn int, w int"),
         "DEMO_H": spark.createDataFrame([(1, 5), (3, 6)], "SEQN int, age int"),
         "OTHER": spark.createDataFrame([(1,)], "x int")}
    got = combine.merge_surveys(t)
    assert got.columns == ["seqn", "w_BMX", "age_DEMO"]
    assert sorted(values(got, *got.columns)) == [(1, 10, 5), (2, 20, None), (3, None, 6)]


def test_join_by_respondent_with_one_very_busy_person(spark):
    demo = spark.range(100).select(F.col("id").alias("p"), (F.col("id") * 2).alias("a"))
    health = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 90).alias("p"), F.col("id").alias("h"))
    for how in ("left", "inner", "full"):
        got = combine.join_by_respondent(demo, health, "p", how).select("p", "a", "h")
        want = demo.join(health, "p", how).select("p", "a", "h")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_zipped_samples_have_the_smallest_size(spark):
    got = combine.zip_samples({"a": spark.range(50).toDF("k"), "b": spark.range(30).toDF("k")},
                              {"a": ["k"], "b": ["k"]})
    assert got.columns == ["position", "a_k", "b_k"] and got.count() == 30


def test_too_few_shared_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2.5,)], "a double")
    with pytest.raises(ValueError):
        combine.union_common([a, b])
    assert sorted(map(tuple, combine.union_all_columns([a, b]).collect())) == [(1.0, "x"), (2.5, "0")]


def test_sample_is_the_smallest_hashes_and_stable(spark):
    df = spark.range(20_000).toDF("k")
    a = {r["k"] for r in sampling.sample_rows(df, 500, ["k"]).collect()}
    b = {r["k"] for r in sampling.sample_rows(df.repartition(13), 500, ["k"]).collect()}
    assert len(a) == 500 and a == b
    assert sampling.sample_rows(df, 50_000, ["k"]).count() == 20_000


# --- profiles -----------------------------------------------------------------

def test_mode_ties_and_empty(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)],
                               "x string, y string")
    got = {r["column_name"]: r["mode_value"] for r in profile.mode_of(df, ["x", "y"]).collect()}
    assert got == {"x": "a", "y": "Unknown"}


def test_histogram_of_a_constant(spark):
    h = profile.histogram(spark.createDataFrame([(2.0,)] * 4, "x double"), "x", 4).collect()
    assert sum(r["n"] for r in h) == 4 and len(h) == 4


# --- cleaning -----------------------------------------------------------------

def test_median_of_an_empty_column_stays_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "x double, y double")
    assert sorted(values(clean.impute_median(df, ["x", "y"]), "x", "y")) == [(1.0, None), (2.5, None), (4.0, None)]


def nan_knn(data, k=5):
    """Brute force: mean of the k nearest rows that have the value."""
    out = data.copy()
    for i, row in enumerate(data):
        for j in np.flatnonzero(np.isnan(row)):
            far = []
            for o, other in enumerate(data):
                both = ~np.isnan(row) & ~np.isnan(other)
                if both.any() and not np.isnan(other[j]):
                    far.append((((row - other)[both] ** 2).sum() * len(row) / both.sum(), o))
            near = [o for _, o in sorted(far)[:k]]
            out[i, j] = data[near, j].mean() if near else np.nanmean(data[:, j])
    return out


def holed(n=120, cols=4, share=0.2, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 1)) @ rng.normal(size=(1, cols)) + 0.3 * rng.normal(size=(n, cols))
    data = base.copy()
    data[rng.random((n, cols)) < share] = np.nan
    return base, data


def frame(spark, data):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, "k int, " + ", ".join(f"c{j} double" for j in range(data.shape[1])))


def matrix(df, n):
    return np.array([[r[f"c{j}"] for j in range(n)] for r in df.orderBy("k").collect()])


@pytest.mark.parametrize("cell_rows", [1, 7, 50_000])
def test_knn_is_brute_force(spark, cell_rows):
    _, data = holed()
    data[5] = np.nan
    got = clean.impute_knn(frame(spark, data), ["c0", "c1", "c2", "c3"], "k", cell_rows=cell_rows)
    assert matrix(got, 4) == pytest.approx(nan_knn(data), rel=1e-9)
    assert got.count() == len(data) and got.select("c1").where("c1 is null").count() == 0


def chained(data, iters=10, tol=1e-3):
    """Brute force round-robin least squares from mean fill."""
    gaps = np.isnan(data)
    out = np.where(gaps, np.nanmean(data, axis=0), data)
    span = np.nanmax(data, axis=0) - np.nanmin(data, axis=0)
    for _ in range(iters):
        moved = 0.0
        for j in sorted(range(data.shape[1]), key=lambda j: gaps[:, j].sum()):
            others = [o for o in range(data.shape[1]) if o != j]
            x = np.column_stack([np.ones(len(out)), out[:, others]])
            w, *_ = np.linalg.lstsq(x[~gaps[:, j]], out[~gaps[:, j], j], rcond=None)
            new = x[gaps[:, j]] @ w
            moved = max(moved, np.abs(new - out[gaps[:, j], j]).max() / span[j])
            out[gaps[:, j], j] = new
        if moved < tol:
            break
    return out


def test_mice_is_brute_force_and_better_than_the_mean(spark):
    base, data = holed()
    got = matrix(clean.impute_mice(frame(spark, data), ["c0", "c1", "c2", "c3"]), 4)
    assert got == pytest.approx(chained(data), rel=1e-5, abs=1e-5)
    by_scans = matrix(clean.impute_mice(frame(spark, data), ["c0", "c1", "c2", "c3"], most_patterns=3), 4)
    assert by_scans == pytest.approx(chained(data), rel=1e-5, abs=1e-5)
    gaps = np.isnan(data)
    mean = np.where(gaps, np.nanmean(data, axis=0), data)
    assert np.abs(got - base)[gaps].mean() < 0.8 * np.abs(mean - base)[gaps].mean()


def test_imputation_method(spark):
    _, data = holed()
    df = frame(spark, data)
    cols = ["c0", "c1", "c2", "c3"]
    median = matrix(clean.impute_median(df, cols), 4)
    assert matrix(clean.impute_auto(df, cols, "median"), 4) == pytest.approx(median)
    assert matrix(clean.impute_auto(df, cols), 4) == pytest.approx(chained(data), rel=1e-5, abs=1e-5)
    assert matrix(clean.impute_auto(df, cols, "knn", "k"), 4) == pytest.approx(nan_knn(data), rel=1e-9)


def test_winsorize_rules(spark):
    rows = [(float(i), 1.0, None, float(i) if i < 9 else None) for i in range(20)] + [(1000.0, 1.0, None, None)]
    df = spark.createDataFrame(rows, "a double, flat double, empty double, few double")
    bounds = clean.iqr_bounds(df)
    assert set(bounds) == {"a"}
    assert bounds["a"] == pytest.approx((5 - 15, 15 + 15))
    assert clean.clip_to(df, bounds).agg(F.max("a"), F.count("few")).first()[:] == (30.0, 9)


@pytest.mark.parametrize("n, kind", [(1, "gone"), (2, "binary"), (10, "onehot"), (11, "ordinal")])
def test_encoding_by_distinct_count(spark, n, kind):
    df = spark.range(500).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") % n).cast("string"), 2, "0")).alias("t"))
    got = clean.encode_auto(df)
    if kind == "gone":
        assert got.columns == ["id"]
    elif kind == "binary":
        assert {r["t"] for r in got.collect()} == {0, 1}
    elif kind == "onehot":
        assert got.columns == ["id"] + [f"t_v{i:02d}" for i in range(1, 10)]
    else:
        assert {(r["id"] % 11, r["t"]) for r in got.collect()} == {(i, i) for i in range(11)}


def test_ordinal_codes_of_unseen_values(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "t string")
    levels, size = clean.ordinal_levels(train, "t")
    got = clean.encode_ordinal(spark.createDataFrame([("c",), ("x",), (None,)], "t string"), "t",
                               levels=levels, levels_bytes=size)
    assert sorted(r["t"] for r in got.collect()) == [-1, -1, 2]


def test_ordinal_codes_of_a_hot_value_without_broadcast(spark, monkeypatch):
    from medlark.functions import joins
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.lpad(F.col("id").cast("string"), 5, "0")).alias("t"))
    got = {r["id"]: r["t"] for r in clean.encode_ordinal(df, "t").collect()}
    order = sorted({"hot" if i % 3 == 0 else f"{i:05d}" for i in range(9000)})
    rank = {v: i for i, v in enumerate(order)}
    assert got == {i: rank["hot" if i % 3 == 0 else f"{i:05d}"] for i in range(9000)}


def test_scaling(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(3.0).alias("flat"))
    s = clean.scale_standard(df).agg(F.avg("x"), F.stddev_pop("x"), F.max("flat"), F.min("flat")).first()
    assert s[:] == pytest.approx((0, 1, 0, 0), abs=1e-9)
    assert clean.scale_minmax(df).agg(F.min("x"), F.max("x"), F.max("flat")).first()[:] == (0.0, 1.0, 0.0)


def test_clean_tables_logs_failures_and_goes_on(spark):
    out = scratch_path(spark, "cleaned")
    good = spark.range(50).select((F.col("id") % 7).cast("double").alias("A x"), F.col("id").cast("string").alias("s"))
    bad = spark.createDataFrame([(1, 2)], "`X y` int, x_y int")
    paths = clean_tables(spark, {"good": good, "bad": bad, "none": spark.createDataFrame([], "a int")}, out, "r")
    log = {r["table_name"]: r["status"] for r in spark.read.parquet(f"{out}/audit").collect()}
    assert log == {"good": "ok", "bad": "failed", "none": "skipped"}
    assert spark.read.parquet(paths["good"]).count() == 50


def test_protect_and_fuse_tables_log_every_table(spark):
    out = scratch_path(spark, "stages")
    people = spark.range(300).select(
        F.concat(F.lit("p"), "id").alias("patient_id"), (F.col("id") % 90).cast("int").alias("age"),
        (F.col("id") % 2).cast("string").alias("sex"), (F.col("id") % 17).cast("double").alias("cost"))
    paths = protect_tables(spark, {"people": people, "plain": people.select("cost")}, out, "r", salt="s")
    assert set(spark.read.parquet(paths["people"]).columns) == {"patient_id_hash", "age_group", "sex", "cost"}
    assert spark.read.parquet(paths["plain"]).count() == 300
    numbers = people.select(*[(F.col("age") * i + F.col("cost")).alias(f"f{i}") for i in range(4)])
    fused = fuse_to(spark, {"a": numbers}, out, "r", {"one": ["a"], "two": ["absent"]}, n=3)
    assert list(fused) == ["one"] and spark.read.parquet(fused["one"]).count() == 300
    log = spark.read.parquet(f"{out}/audit")
    assert {(r["table_name"], r["status"]) for r in log.collect()} == {
        ("people", "ok"), ("plain", "ok"), ("one", "ok")}


def test_default_grid_size():
    assert len(models.boosted_grid(models.boosted_trees_classifier(["a"]))) == 72


# --- features -----------------------------------------------------------------

def test_log_rule(spark):
    rows = [(float(2 ** (i % 12)), float(-(2 ** (i % 12))), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "skewed double, negative double, even double")
    assert features.log_skewed(df).columns == ["skewed", "negative", "even", "skewed_log"]


def test_all_products_of_the_top_columns(spark):
    df = spark.range(20).select(*[(F.col("id") * (i + 1)).alias(f"c{i:02d}") for i in range(40)])
    assert len(features.top_variance_products(df).columns) == 40 + 105
    assert features.top_variance_products(df.select("c00", "c01")).columns == ["c00", "c01", "c01_x_c00"]
    assert len(features.poly_interactions(df).columns) == 40 + 45
    assert len(features.cross_named(df, ["c0"], ["c1"]).columns) == 40 + 100


def test_six_quasi_ids_count(spark):
    df = spark.range(64).select(*[F.expr(f"(id >> {i}) % 2").alias(f"q{i}") for i in range(6)])
    names = [f"q{i}" for i in range(6)]
    assert privacy.k_anonymity(df, names).first()["k_min"] == 1
    assert privacy.k_anonymity(df, names[:5]).first()["k_min"] == 2
    assert privacy.enforce_k(df, names, 2).count() == 0


def test_pca_explains_and_orders_variance(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 2)) @ rng.normal(size=(2, 6)) + 0.05 * rng.normal(size=(300, 6))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"c{i} double" for i in range(6)))
    done = features.pca(df, df.columns, 4)
    got = np.array([[r[f"PC{i}"] for i in range(1, 5)] for r in done.table.collect()])
    z = (data - data.mean(0)) / data.std(0)
    vals = np.linalg.svd(z, compute_uv=False) ** 2
    assert (got ** 2).sum(0) == pytest.approx(vals[:4], rel=1e-6)
    assert done.explained == pytest.approx(list(vals[:4] / vals.sum()), rel=1e-6)


def test_information_finds_the_informative_column(spark):
    df = spark.range(2000).select(
        (F.col("id") % 2).alias("y"), (F.col("id") % 2 + F.rand(1) * 0.1).alias("good"), F.rand(2).alias("noise"))
    mi = {r["feature"]: r["mi"] for r in features.mutual_information(df, "y", ["good", "noise"]).collect()}
    assert mi["good"] == pytest.approx(math.log(2), abs=0.01) and mi["noise"] < 0.02
    assert features.select_by_mi(df, "y", ["good", "noise"], k=1).columns == ["y", "good"]


def test_fuse_and_combine(spark):
    def part(seed):
        return spark.range(200).select(
            (F.col("id") % 2).alias("target"), *[(F.rand(seed + i) * 10).alias(f"f{i}") for i in range(4)])
    fused = fuse({"a": part(1), "b": part(2)}, {"one": ["a", "b"], "two": ["b"]}, n=3)
    assert fused["one"].label == "target"
    assert fused["one"].table.columns == ["PC1", "PC2", "PC3", "target"] and fused["one"].table.count() == 400
    both = combine_plan({d: r.table for d, r in fused.items()}, {d: ["PC1", "PC2", "PC3"] for d in fused})
    assert both.count() == 200 and both.columns[1] == "one_PC1"


def test_combine_has_no_size_of_its_own(spark):
    domains = {"a": spark.range(50_300).toDF("k"), "b": spark.range(50_200).toDF("k")}
    keys = {"a": ["k"], "b": ["k"]}
    assert combine_plan(domains, keys).count() == combine_plan(domains, keys, None).count() == 50_200
    assert combine_plan(domains, keys, n=70).count() == 70


# --- privacy ------------------------------------------------------------------

def test_age_bands_are_right_closed(spark):
    df = spark.createDataFrame([(18,), (30,), (31,), (80,), (81,), (None,)], "age int")
    got = [r[0] for r in privacy.age_bands(df, "age").collect()]
    assert got == ["<18", "18-29", "30-39", "70-79", "80+", "<18"]


def test_bands_leave_small_and_whole_number_columns(spark):
    few = spark.range(100).select((F.col("id") % 20).cast("double").alias("x"), F.col("id").alias("n"))
    assert privacy.quantile_bands(few, "x").columns == ["x", "n"]
    assert privacy.quantile_bands(few, "n").columns == ["x", "n"]


def test_equal_band_edges_are_merged(spark):
    df = spark.range(100).select(F.greatest(F.col("id") - 70, F.lit(0)).cast("double").alias("x"))
    got = {r[0]: r[1] for r in privacy.quantile_bands(df, "x").groupBy("x_bin").count().collect()}
    assert sum(got.values()) == 100 and len(got) == 2


def test_without_quasi_ids_k_is_minus_one(spark):
    assert privacy.k_anonymity(spark.range(3)).first()["k_min"] == -1


@pytest.mark.parametrize("k", [2, 5])
def test_after_suppression_every_group_has_k(spark, k):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("q"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("r"))
    kept = privacy.enforce_k(df, ["q", "r"], k)
    sizes = df.groupBy("q", "r").count().collect()
    assert kept.count() == sum(r["count"] for r in sizes if r["count"] >= k)
    assert kept.groupBy("q", "r").count().agg(F.min("count")).first()[0] >= k


def test_noise_is_repeatable_and_near_theory(spark):
    df = spark.range(5000).select("id", F.lit(10.0).alias("x"))
    a = [r["x"] for r in privacy.laplace_noise(df, ["x"], ["id"], "s").orderBy("id").collect()]
    b = [r["x"] for r in privacy.laplace_noise(df.repartition(9), ["x"], ["id"], "s").orderBy("id").collect()]
    assert a == b
    assert np.mean(a) == pytest.approx(10, abs=0.1) and np.std(a) == pytest.approx(math.sqrt(2), rel=0.1)


def test_too_few_columns_for_utility(spark):
    assert privacy.utility_report(spark.range(3), spark.range(3)).first()["status"] == "insufficient_data"


def test_protect_table(spark):
    df = spark.range(400).select(
        F.concat(F.lit("p"), "id").alias("patient_id"), (F.col("id") % 90).cast("int").alias("age"),
        (F.col("id") % 2).cast("string").alias("sex"), (F.col("id") * 1.5).alias("cost"))
    done = protect_table(df, ["patient_id"], ["age", "sex"], ages=["age"], release_by=["sex"],
                         release={"n": privacy.Release("count")}, salt="s")
    assert set(done.table.columns) == {"patient_id_hash", "age_group", "sex", "cost"}
    assert done.k_after.first()["k_min"] >= 5 and done.release.count() == 2


# --- series -------------------------------------------------------------------

def one_series(spark, y, start="2020-01-31"):
    return spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "k string, i int, value double").select(
        "k", F.add_months(F.lit(start).cast("date"), F.col("i")).cast("timestamp_ntz").alias("period"), "value")


def test_cusum_is_the_loop(spark):
    rng = np.random.default_rng(2)
    y = np.concatenate([rng.normal(0, 1, 150), rng.normal(2, 1, 60), rng.normal(-3, 1, 60)])
    got = series.cusum(one_series(spark, y), ["k"]).orderBy("idx").collect()
    z = (y - y.mean()) / y.std()
    up = down = 0.0
    for i, r in enumerate(got):
        if i:
            up, down = max(0, up + z[i] - 0.5), min(0, down + z[i] + 0.5)
        assert (r["cusum_pos"], r["cusum_neg"]) == pytest.approx((up, down), abs=1e-9)
    alerts = series.cusum_anomalies(series.cusum(one_series(spark, y), ["k"])).groupBy("type").count().collect()
    assert {r["type"] for r in alerts} == {"upward_spike", "downward_drop"}


def test_short_or_flat_series_have_no_cusum_but_are_counted(spark):
    for y in ([1, 2, 3] * 3, [4] * 30):
        s = one_series(spark, y)
        assert series.cusum(s, ["k"]).count() == 0
        assert series.alert_counts(s, ["k"]).first()[1:] == (len(y), 0, 0)


def test_linear_forecast(spark):
    y = [50, 3, 5, 4, 8, 9, 9, 12, 15, 14, 18, 20, 21, 25]
    got = series.linear_forecast(one_series(spark, y), ["k"], horizon=3).orderBy("step").collect()
    x = np.arange(12)
    s, i = np.polyfit(x, y[-12:], 1)
    sd = np.std(np.array(y[-12:]) - (s * x + i))
    for r in got:
        f = s * (11 + r["step"]) + i
        assert (r["slope"], r["forecast"], r["lower"], r["upper"]) == pytest.approx((s, f, f - 1.96 * sd, f + 1.96 * sd))
    assert [str(r["forecast_date"]) for r in got] == ["2021-03-31", "2021-04-30", "2021-05-31"]
    short = series.linear_forecast(one_series(spark, y[:11]), ["k"]).collect()
    assert len(short) == 1 and short[0]["step"] is None and short[0]["forecast"] is None


def test_falling_forecast_stops_at_zero(spark):
    got = series.linear_forecast(one_series(spark, range(24, 0, -2)), ["k"]).collect()
    assert all(r["forecast"] == 0 and r["lower"] == 0 for r in got)


def test_trend_ends_are_filled(spark):
    y = list(range(20))
    got = [r["trend"] for r in series.centered_trend(one_series(spark, y), ["k"]).orderBy("period").collect()]
    want = [np.mean(y[i - 6:i + 6]) if 6 <= i <= 14 else None for i in range(20)]
    assert got == [w if w is not None else (want[6] if i < 6 else want[14]) for i, w in enumerate(want)]


def test_drift_forecast(spark):
    y = [3.0, 9, 4, 8, 2, 7, 7, 1, 5, 9, 3, 6, 8, 4]
    got = series.drift_forecast(one_series(spark, y), ["k"], steps=2).orderBy("step").collect()
    last = np.array(y[-12:])
    drift = np.diff(last).mean()
    assert [r["forecast"] for r in got] == pytest.approx([4 + drift, 4 + 2 * drift])
    assert got[0]["upper"] == pytest.approx(4 + drift + 1.96 * last.std(ddof=1))


def test_series_need_a_key_and_a_known_period(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "bad", 1.0), ("a", "2024-01-01", None)],
                               "k string, ts string, v double")
    with pytest.raises(ValueError):
        series.prepare_series(df, [], "ts", "v")
    with pytest.raises(ValueError):
        series.prepare_series(df, ["k"], "ts", "v", "second")
    assert series.prepare_series(df, ["k"], "ts", "v").count() == 1
    assert series_alerts(df, ["k"], "ts", "v").count() == 1
    line = series_forecast(df, ["k"], "ts", "v").collect()
    assert len(line) == 1 and line[0]["step"] is line[0]["slope"] is line[0]["forecast"] is None


# --- models -------------------------------------------------------------------

@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 40])
def test_auc_with_ties(spark, rows_per_bucket):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 500)
    s = np.round(rng.random(500) * 0.7 + y * 0.2, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    got = models.binary_metrics(df, rows_per_bucket=rows_per_bucket).first()
    tp, fp = ((s >= 0.5) & (y == 1)).sum(), ((s >= 0.5) & (y == 0)).sum()
    assert got["auc"] == pytest.approx(want) and got["n_rows"] == 500
    assert got["precision"] == pytest.approx(tp / (tp + fp)) and got["recall"] == pytest.approx(tp / y.sum())
    roc = models.roc_points(df, rows_per_bucket=rows_per_bucket).orderBy("threshold").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (1.0, 1.0) and len(roc) == len(set(s))


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    got = models.binary_metrics(df).first()
    assert got["auc"] is None and got["f1"] == 0.0


def test_split_and_folds_keep_class_shares(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    split = models.stratified_split(df, "y", ["id"]).groupBy("y").agg(F.sum("is_test").alias("t")).collect()
    assert {r["y"]: r["t"] for r in split} == {0: 180, 1: 20}
    folds = models.stratified_folds(df, "y", ["id"]).groupBy("y", "fold").count().collect()
    assert {(r["y"], r["count"]) for r in folds} == {(0, 180), (1, 20)} and len(folds) == 10


@pytest.mark.parametrize("same_day", [False, True])
def test_expanding_folds(spark, same_day):
    """Also when every second row has the same time."""
    when = "IF(id % 2 = 0, 100, id)" if same_day else "id"
    df = spark.range(100).selectExpr("id", f"timestamp_ntz'2024-01-01' + make_dt_interval({when}) AS t")
    got = models.expanding_folds(df, "t", ["id"]).select("test_fold", "t").collect()
    sizes = [sum(r["test_fold"] == f for r in got) for f in range(6)]
    assert sizes == [20, 16, 16, 16, 16, 16]
    for f in range(5):
        assert max(r["t"] for r in got if r["test_fold"] == f) <= min(r["t"] for r in got if r["test_fold"] == f + 1)


def test_models_learn_and_survive_storage(spark):
    df = spark.range(600).select(
        "id", (F.rand(1) * 10).alias("a"), F.rand(2).alias("b")).withColumn(
        "label", (F.col("a") + F.rand(3) > 5.5).cast("int"))
    train = models.add_class_weight(df).cache()
    fitted = {
        "gbt": models.boosted_trees_classifier(["a", "b"], trees=5).fit(train),
        "forest": models.random_forest_classifier(["a", "b"], trees=10, depth=4).fit(train),
        "logistic": models.balanced_logistic(["a", "b"]).fit(train),
    }
    scored = models.soft_vote(fitted, train)
    for s in ("score_gbt", "score_forest", "score_logistic", "vote_score"):
        assert models.binary_metrics(scored, "label", s).first()["auc"] > 0.9
    for m in fitted.values():
        imp = {r["feature"]: r["importance"] for r in models.feature_importance(m, train, ["a", "b"]).collect()}
        assert imp["a"] > imp["b"]
    moved = models.shuffle_importance(fitted["gbt"], train, ["a", "b"], ["id"], rows_per_bucket=50)
    assert sampling.top_features(moved, 1).first()["feature"] == "a"
    path = scratch_path(spark, "model")
    models.save_model(fitted["forest"], path)
    again = models.score(models.load_model(spark, path), train)
    assert again.exceptAll(models.score(fitted["forest"], train)).count() == 0
    outside = models.score_external(fitted["forest"], df.select(F.col("a").alias("x"), "b"), ["a", "b"], {"a": "x"})
    assert outside.summary.first()["n"] == 600
    with pytest.raises(ValueError):
        models.score_external(fitted["forest"], df.select("b"), ["a", "b"])


def test_best_model_and_bands(spark):
    m = spark.createDataFrame([("b", 0.9, 0.1, 5), ("a", 0.9, 0.2, 5), ("c", None, 0.3, 5)],
                              "model string, auc double, f1 double, n_rows int")
    assert models.best_model(m).first()["model"] == "a"
    assert {r["model"]: r["verdict"] for r in reports.model_scorecard(m).collect()} == {
        "a": "good", "b": "good", "c": "improve"}
    bands = reports.risk_bands(spark.createDataFrame([(0.5,), (0.7,), (1.0,), (0.2,), (None,)], "x double"), "x")
    assert [r["band"] for r in bands.collect()] == ["poor", "fair", "very good", "outside", None]


@pytest.mark.parametrize("width", [3, 24])
def test_clean_table_scans_its_table_as_often_at_any_width(spark, monkeypatch, width):
    """Jobs over the stored table: their number is the same for few and for many columns."""
    rows = [(i, *[None if (i + j) % 7 == 0 else float((i * 31 + j * j) % 97) for j in range(width)],
             *["abc"[(i + j) % 3] for j in range(width)]) for i in range(300)]
    names = ", ".join([f"x{j} double" for j in range(width)] + [f"t{j} string" for j in range(width)])
    df = spark.createDataFrame(rows, "k int, " + names)
    reads = []
    for owner, name in ((quantiles, "_long"), (cleaning_plan, "null_counts"), (cleaning_plan, "TextValues"), (clean, "fit_standard")):
        real = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, _real=real, _name=name, **b: (reads.append(_name), _real(*a, **b))[1])
    cleaning_plan.clean_table(df, keep=["k"], impute="median").count()
    # One unpivoted view for three jobs on the numbers, and one job for each of the others.
    assert sorted(reads) == ["TextValues", "_long", "fit_standard", "null_counts"]


# --- bounded releases, trees of files -----------------------------------------

def test_rows_of_a_person_are_bounded_whatever_the_partitions(spark):
    df = spark.createDataFrame([(i, i % 4 if i < 40 else 9, 1.0) for i in range(400)], "id int, who int, v double")
    for parts in (1, 7):
        kept = privacy.bounded_rows(df.repartition(parts), ["who"], 3, ["id"], "s")
        ids = sorted(r["id"] for r in kept.collect())
        assert len(ids) == 15
        first = ids if parts == 1 else first
        assert ids == first
    with pytest.raises(ValueError):
        privacy.dp_aggregate(df, ["who"], {"n": privacy.Release("count")}, "s", most_rows=2)
    with pytest.raises(ValueError):
        privacy.dp_aggregate(df, ["who"], {"n": privacy.Release("count")}, "s", person=["who"])


def test_noise_covers_all_rows_of_a_person(spark):
    df = spark.createDataFrame([(i, i) for i in range(3000)], "id int, g int")
    noise = [r["n"] - 1 for r in privacy.dp_aggregate(
        df, ["g"], {"n": privacy.Release("count")}, "s", person=["id"], most_rows=4, key=["id"]).collect()]
    assert np.std(noise) == pytest.approx(4 * math.sqrt(2), rel=0.1)


def test_a_release_over_budget_is_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, g string")
    path = scratch_path(spark, "ledger")

    def release(eps):
        ledger = privacy.Ledger(spark, path, 1.0)
        privacy.dp_aggregate(df, ["g"], {"n": privacy.Release("count")}, "s", eps=eps, ledger=ledger)
        return ledger.spent()

    assert release(0.6) == pytest.approx(0.6)
    with pytest.raises(privacy.BudgetSpent):
        release(0.5)
    # What was refused is not spent.
    assert release(0.4) == pytest.approx(1.0)
    with pytest.raises(privacy.BudgetSpent):
        release(0.01)
    with pytest.raises(ValueError):
        release(0.0)


def test_tree_of_odd_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "__MACOSX").mkdir()
    (tmp_path / "a" / "one.csv").write_bytes("\ufeffname;n\nJos\u00e9;1\n\n".encode())
    (tmp_path / "a" / "two.csv").write_bytes("name;n\nJos\u00e9;2\nAnn;x\n".encode("latin-1"))
    (tmp_path / "a" / "three.txt").write_text("name\tn\nAnn\t3.5\n")
    (tmp_path / "heart.data").write_text("1,2,a\n3,4,b\n")
    (tmp_path / "wrapped.json").write_text('{"value": [{"k": {"x": 1}}, {"k": {"x": 2}}]}')
    (tmp_path / "list.json").write_text('[{"k": 1}, {"k": 2}, {"k": 3}]')
    (tmp_path / "lines.json").write_text('{"k": 1}\n{"k": 2}\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "photo.jpg").write_bytes(b"\xff\xd8")
    (tmp_path / "__MACOSX" / "junk.csv").write_text("a,b\n1,2\n")
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "a" / "written"))
    got = tree.read_tree(spark, f"file://{tmp_path}")
    rows = {name: (df.columns, sorted(map(tuple, df.collect()), key=str)) for name, df in got.items()}
    assert rows == {
        "a__one": (["name", "n"], [("Jos\u00e9", 1)]), "a__two": (["name", "n"], [("Ann", "x"), ("Jos\u00e9", "2")]),
        "a__three": (["name", "n"], [("Ann", 3.5)]), "heart": (["0", "1", "2"], [(1, 2, "a"), (3, 4, "b")]),
        "wrapped": (["k.x"], [(1,), (2,)]), "list": (["k"], [(1,), (2,), (3,)]), "lines": (["k"], [(1,), (2,)]),
        "a__written": (["id"], [(0,), (1,), (2,)])}


def test_files_of_one_table_must_be_alike(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "t" / "part-1.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError):
        tree.read_tree(spark, f"file://{tmp_path}")


def test_cleaning_by_neighbours_searches_once(spark, monkeypatch):
    """Bounds, codes and scaling scan the filled table; none of these scans repeats the search."""
    found, inner = spark.sparkContext.accumulator(0), neighbours.CellTree.nearest_means

    def counted(batches):
        for b in batches:
            found.add(b.num_rows)
            yield b

    monkeypatch.setattr(neighbours.CellTree, "nearest_means", lambda self, q: (m := inner(self, q)).mapInArrow(counted, m.schema))
    df = spark.range(200).select(
        F.col("id").alias("key"), (F.col("id") * 3 % 101).cast("double").alias("a"),
        F.when(F.col("id") % 8 != 0, F.col("id") * 1.5).alias("b"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("kind"))
    asked = df.where(F.col("b").isNull()).select("a").distinct().count()
    done = cleaning_plan.clean_table(df, keep=["key"], key="key", impute="knn", scaling="minmax")
    assert done.where(F.col("b").isNull()).count() == 0 and done.agg(F.sum("kind")).first()[0] is not None
    assert found.value == asked
