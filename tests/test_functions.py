"""The shared helpers, with limits set low so that their large-table paths run."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medlark.functions import information, joins, moments, neighbours, ranking, values
from medlark.functions.hashing import keyed_laplace, keyed_uniform
from medlark.functions.quantiles import exact_quantiles, filled_with_median, order_statistics
from medlark.functions.ranking import running_totals
from medlark.functions.stats import column_stats, small_distinct_counts


def column(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double").repartition(5)


def skewed(n=4000):
    rng = np.random.default_rng(1)
    return [float(x) for x in np.where(rng.random(n) < 0.35, 7.0, rng.exponential(20, n))]


@pytest.mark.parametrize("values", [
    skewed(), [1.0], [1.0, 2.0], [5.0] * 500, [float(i % 3) for i in range(700)],
    [-0.5, 1e300, -1e300, 3.0, 3.0],
])
@pytest.mark.parametrize("pick_limit", [100_000, 3])
def test_quantiles_are_exact(spark, values, pick_limit):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(column(spark, values), ["x"], probs, pick_limit)["x"]
    want = [float(np.quantile(values, p)) for p in probs]
    assert got == pytest.approx(want, rel=1e-12)


def test_quantiles_survive_a_wrong_bracket(spark, monkeypatch):
    """A sketch that is far off costs rounds, not correctness."""
    from medlark.functions import quantiles as q
    real = F.percentile_approx

    def wrong(c, probs, accuracy):
        return real(c, [min(1.0, p * 0.3) for p in probs], 50)

    monkeypatch.setattr(q.F, "percentile_approx", wrong)
    values = skewed()
    got = exact_quantiles(column(spark, values), ["x"], [0.5, 0.9])["x"]
    assert got == pytest.approx([float(np.quantile(values, p)) for p in (0.5, 0.9)], rel=1e-12)


def test_quantiles_of_many_columns_and_ranks_fit_the_drivers_stack(spark):
    """With so many rows that no sketch has the ranks themselves: each is looked up in its bracket."""
    rows, probs = 25_000, [i / 10 for i in range(1, 10)]
    df = spark.range(rows).select(*[(F.pmod(F.col("id") * (2 * k + 1), F.lit(rows)) * 1.5 - k).alias(f"c{k}") for k in range(80)])
    got = exact_quantiles(df, df.columns, probs)
    for k in (0, 2, 41, 79):
        values = [(i * (2 * k + 1)) % rows * 1.5 - k for i in range(rows)]
        assert got[f"c{k}"] == pytest.approx(np.quantile(values, probs).tolist(), rel=1e-12)


def test_quantiles_of_many_columns_skip_null_and_nan(spark):
    rows = [(float(i), None if i % 2 else float(-i), float("nan")) for i in range(101)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_quantiles(df, ["a", "b", "c"], [0.5])
    assert got == {"a": [50.0], "b": [-50.0], "c": [None]}


def test_order_statistics(spark):
    values = skewed(999)
    ranks = [0, 1, 500, 998]
    got = order_statistics(column(spark, values), {"x": F.col("x"), "neg": -F.col("x")},
                           {"x": ranks, "neg": [2]}, {"x": 999, "neg": 999}, pick_limit=10)
    assert got == {"x": [sorted(values)[r] for r in ranks], "neg": [-sorted(values)[-3]]}


@pytest.mark.parametrize("rows_per_bucket", [10_000, 50])
def test_running_totals(spark, rows_per_bucket):
    values = sorted(set(skewed(3000)))
    df = column(spark, values).withColumn("one", F.lit(1)).withColumn("two", F.col("x") * 0 + 2)
    got = running_totals(df, "x", {"a": "one", "b": "two"}, rows_per_bucket=rows_per_bucket)
    rows = sorted((r["x"], r["a"], r["b"]) for r in got.collect())
    assert rows == [(v, i + 1, 2.0 * (i + 1)) for i, v in enumerate(values)]


def test_running_totals_over_text(spark):
    words = [f"w{i}" for i in range(1000)]
    df = spark.createDataFrame([(w, 1) for w in words], "w string, one int")
    got = running_totals(df, "w", {"rank": "one"}, rows_per_bucket=40).collect()
    assert {r["w"]: r["rank"] for r in got} == {w: i + 1 for i, w in enumerate(sorted(words))}


def hot_table(spark, n, hot, name):
    """A third of the rows share one key, some keys are null."""
    rows = [(hot if i % 3 == 0 else (None if i % 50 == 1 else i), i) for i in range(n)]
    return spark.createDataFrame(rows, f"k int, {name} int").repartition(6)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("left_hot, right_hot", [(9, 10), (9, 9), (9, -1)])
def test_outer_join_with_hot_keys_apart_is_the_plain_join(spark, left_hot, right_hot):
    a = hot_table(spark, 4500, left_hot, "a")
    b = hot_table(spark, 100, right_hot, "b") if right_hot == 9 else hot_table(spark, 3600, right_hot, "b")
    assert joins.hot_key_hashes(a, ["k"], 500)
    want = bag(a.join(b, "k", "full").select("k", "a", "b"))
    for x in (a, a.repartition(7)):
        assert bag(joins.outer_join(x, b, ["k"], hot_rows=500).select("k", "a", "b")) == want


def test_chain_with_a_hot_key_grows_by_the_same(spark):
    tables = [hot_table(spark, 600, 9, f"c{i}").where(f"k <> 9 or c{i} is not null").limit(400) for i in range(2)]
    tables += [spark.createDataFrame([(9, f"x{i}"), (1, "y")], f"k int, d{i} string") for i in range(3)]
    sizes = []
    for n in (3, 4, 5):
        plan = joins.hot_outer_chain(tables[:n], ["k"], hot_rows=100)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(plan.count("Join"))
    assert sizes[0] == sizes[1] == sizes[2]


def test_even_keys_are_not_hot(spark):
    assert joins.hot_key_hashes(spark.range(50_000), ["id"]) == {}


def test_keyed_uniform_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    u = keyed_uniform("id", salt="s").alias("u")
    a = [r["u"] for r in df.select("id", u).orderBy("id").collect()]
    b = [r["u"] for r in df.repartition(7).select("id", u).orderBy("id").collect()]
    assert a == b and 0 < min(a) and max(a) < 1
    assert np.mean(a) == pytest.approx(0.5, abs=0.03)
    other = [r["u"] for r in df.select("id", keyed_uniform("id", salt="t").alias("u")).orderBy("id").collect()]
    assert a != other


def test_laplace_spread(spark):
    noise = [r[0] for r in spark.range(20_000).select(keyed_laplace("id", salt="s", scale=2.0)).collect()]
    assert np.mean(noise) == pytest.approx(0, abs=0.1)
    assert np.std(noise) == pytest.approx(2 * math.sqrt(2), rel=0.05)


def test_wide_and_narrow_statistics_agree(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(200, 20))
    names = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{n} double" for n in names))
    wanted = ["n", "min", "max", "mean", "std", "std_pop", "var", "skew"]
    wide = column_stats(df, names, wanted)
    for n in ("c0", "c19"):
        narrow = column_stats(df, [n], wanted)[n]
        assert wide[n] == pytest.approx(narrow, rel=1e-9)


def test_distinct_counts_are_exact_near_the_limit(spark):
    df = spark.range(5000).select(*[(F.col("id") % m).cast("string").alias(f"m{m}") for m in (1, 2, 10, 11, 100)],
                                  F.col("id").cast("string").alias("all"))
    got = small_distinct_counts(df, df.columns, 10)
    assert [got[f"m{m}"] for m in (1, 2, 10, 11, 100)] == [1, 2, 10, 11, 100]
    assert got["all"] > 4000


@pytest.mark.parametrize("columns", [2, 13])
def test_extremes_keep_their_type_at_any_width(spark, columns):
    big = 2**53 + 1
    df = spark.range(3).select(
        *[(F.col("id") + big).alias(f"c{i}") for i in range(columns)],
        (F.col("id").cast("decimal(20,0)") + big).alias("dec"), (F.col("id") / 2).alias("half"))
    got = column_stats(df, df.columns, ["n", "min", "max", "mean"])
    assert got["c0"]["min"] == big and got["c1"]["max"] == big + 2 and got["half"]["max"] == 1.0
    assert got["dec"]["max"] == big + 2 and got["dec"]["n"] == 3 and got["half"]["mean"] == 0.5


# --- merged blocks, trees of cells, ranges ------------------------------------

def test_pair_moments_are_pairwise_complete(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(1e6, 1.0, (900, 5)) @ rng.normal(size=(5, 5))
    data[rng.random(data.shape) < 0.3] = np.nan
    data[:, 4] = np.where(np.arange(900) < 5, 3.0, np.nan)
    names = [f"c{i}" for i in range(5)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and j % 2 else float(v) for j, v in enumerate(r)) for r in data],
                               ", ".join(f"{n} double" for n in names)).repartition(7)
    got = moments.pair_moments(df, [F.col(n) for n in names])
    r = got.correlation()
    for i in range(5):
        for j in range(5):
            both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
            assert got.n[i, j] == both.sum()
            x, y = data[both, i], data[both, j]
            if len(x) > 1 and x.std() and y.std():
                assert r[i, j] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)
                assert got.var[i, j] == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-8)
            else:
                assert np.isnan(r[i, j])
    empty = moments.pair_moments(df.limit(0), [F.col("c0"), F.col("c1")])
    assert empty.n.sum() == 0 and np.isnan(empty.correlation()).all()


@pytest.mark.parametrize("cell_rows", [1, 8])
def test_cells_left_out_hold_no_neighbour(spark, cell_rows):
    """Few of all pairs are looked at, also where values are spread out and every row is a point of its own."""
    rng = np.random.default_rng(5)
    rows = [(i, *[None if rng.random() < 0.1 else float(v) for v in rng.normal(0, s, 1).tolist() * 1], None if i % 20 == 0 else float(i % 91))
            for i, s in enumerate(rng.choice([1.0, 30.0], 4000))]
    rows = [(i, a, float(rng.normal()) if i % 7 else None, c) for i, a, c in rows]
    df = spark.createDataFrame(rows, "key int, v0 double, v1 double, v2 double").repartition(4)
    tree = neighbours.CellTree(df, ["v0", "v1", "v2"], 5, cell_rows)
    asking = df.where("v0 is null or v1 is null or v2 is null").withColumn("r", F.col("key").cast("long"))
    queries = asking.select("r", "v0", "v1", "v2", F.explode(F.array_compact(F.array(*[
        F.when(F.col(f"v{i}").isNull(), F.lit(i)) for i in range(3)]))).alias("j"))
    assert tree.pairs(queries).count() < 0.1 * queries.count() * df.count()


@pytest.mark.parametrize("names", [["l_quantity", "l_discount", "l_tax"], ["l_quantity", "l_extendedprice", "l_tax"]])
def test_few_pairs_of_a_large_table_are_looked_at(spark, names):
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    at = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    rows = lines.select(F.monotonically_increasing_id().alias("key"), *[
        (F.when(at != 0, F.col(c)) if c == "l_tax" else F.col(c)).alias(f"v{i}") for i, c in enumerate(names)])
    asking = rows.where("v2 is null").select("v0", "v1", "v2").distinct().withColumn("r", F.monotonically_increasing_id())
    tree = neighbours.CellTree(rows, ["v0", "v1", "v2"], 5)
    pairs = tree.pairs(asking.withColumn("j", F.lit(2))).count()
    receivers = rows.where("v2 is null").count()
    assert 0 < pairs < 0.05 * receivers * (rows.count() - receivers)


@pytest.mark.parametrize("rows_per_bucket", [10_000, 40])
def test_running_totals_of_many_columns(spark, rows_per_bucket):
    rows = [(g, f"{v:05d}", (v * 7) % 5, v / 4) for g in range(3) for v in range(0, 900 // (g + 1))]
    df = spark.createDataFrame(rows, "g int, v string, n int, w double").repartition(6)
    got = running_totals(df, "v", {"upto": "n", "weight": "w"}, rows_per_bucket=rows_per_bucket, group="g").collect()
    want = {}
    for g, v, n, w in sorted(rows):
        last = want.get((g, "last"), (0, 0.0))
        want[g, v] = want[g, "last"] = (last[0] + n, last[1] + w)
    assert len(got) == len(rows) and all((r["upto"], r["weight"]) == want[r["g"], r["v"]] for r in got)


def test_offsets_over_thousands_of_parts(spark):
    df = spark.range(5000).select(F.lit(0).alias("g"), F.col("id").alias("p"), F.col("id").alias("n"))
    got = ranking._offsets(df, "g", "p", {"n": "n"}).collect()
    assert len(got) == 5000 and all(r["_before_n"] == r["p"] * (r["p"] - 1) // 2 for r in got)


def test_no_text_is_exchanged_to_count_distinct_values(spark):
    df = spark.createDataFrame([("a" * 50, 0.0, [1], None), ("b" * 50, -0.0, [1], None), ("a" * 50, float("nan"), None, None),
                                (None, float("nan"), [2, None], None)], "words string, d double, l array<int>, e string")
    found = values.hashed_distinct(df, df.columns)
    assert {r["i"]: r["n"] for r in found.collect()} == {0: 2, 1: 2, 2: 2, 3: 0}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan and not any(
        "words#" in line for line in plan.splitlines() if "Exchange" in line or "HashAggregate" in line)


@pytest.mark.parametrize("missing", [None, {"x": 0.3, "y": 0.0}])
def test_quartiles_of_a_filled_column_without_filling_it(spark, missing):
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 10, 11, 200, 2001):
        x = [None if n > 2 and rng.random() < 0.3 else float(v) for v in rng.integers(0, 40, n)]
        df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(x)], "x double, y double").repartition(3)
        got = filled_with_median(df, ["x", "y"], [0.25, 0.75], missing, pick_limit=20)
        for name, have in (("x", x), ("y", list(map(float, range(n))))):
            known = np.array([v for v in have if v is not None])
            if not len(known):
                assert got[name].n == 0
                continue
            full = np.array([np.median(known) if v is None else v for v in have])
            assert got[name].median == np.median(known)
            assert got[name].quantiles == pytest.approx(np.quantile(full, [0.25, 0.75]).tolist())
            assert got[name].mean == pytest.approx(full.mean())
            assert n < 2 or got[name].std == pytest.approx(full.std(ddof=1))


@pytest.mark.parametrize("rows_per_bucket", [500_000, 20])
def test_neighbour_information_by_hand(spark, rows_per_bucket):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 300).tolist() + [7, None, 9, 9]
    x = [float(v) for v in np.round(rng.normal(0, 3, 300) + np.array(y[:300]), 1)] + [0.5, 1.0, 2.0, None]
    z = rng.normal(size=304).tolist()
    df = spark.createDataFrame(list(zip(y, x, z)), "y int, x double, z double").repartition(5)
    got = {r["feature"]: r["mi"] for r in information.neighbour_information(df, "y", ["x", "z"], rows_per_bucket=rows_per_bucket).collect()}

    def psi(n):
        return -0.5772156649015329 + sum(1 / i for i in range(1, n))

    for name, v in (("x", x), ("z", z)):
        rows = [(a, b or 0.0) for a, b in zip(y, v) if a is not None]
        size = Counter(a for a, _ in rows)
        rows = [r for r in rows if size[r[0]] > 1]
        total = 0.0
        for i, (a, b) in enumerate(rows):
            k = min(3, size[a] - 1)
            far = sorted(abs(d - b) for j, (c, d) in enumerate(rows) if c == a and j != i)[k - 1]
            near = sum(abs(d - b) < far - 1e-9 if far > 1e-9 else d == b for _, d in rows)
            total += psi(k) - psi(size[a]) - psi(near)
        assert got[name] == pytest.approx(max(0.0, psi(len(rows)) + total / len(rows)), abs=1e-9)
    none = information.neighbour_information(df.limit(0), "y", ["x"]).collect()
    assert [tuple(r) for r in none] == [("x", 0.0)]
