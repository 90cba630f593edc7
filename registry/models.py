from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.joins import lookup_join
from medlark.functions.ranking import ROWS_PER_BUCKET
from medlark.functions.stats import column_stats
from medlark.functions.storage import cut_lineage, scratch_path
from medlark.operators import models
from medlark.operators.contributions import contribution_importance
from medlark.plans import admissions
from medlark.plans.risk import train_risk_models, train_stay_model
from registry.base import day, query, rounded, table, uniform_sql
from registry.features import TEXT, TEXT_SQL, text_features

CUT = 1000.0


@query("stratified_split", f"""
WITH u AS (SELECT doc_id, quality, {uniform_sql('42', 'doc_id')} AS u FROM labels),
c AS (SELECT quality, quantile_cont(u, 0.2) AS cut FROM u GROUP BY 1)
SELECT doc_id, quality, CASE WHEN u <= cut THEN 1 ELSE 0 END AS is_test
FROM u JOIN c USING (quality)""")
def stratified_split(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return models.stratified_split(labels, "quality", ["doc_id"])


@query("stratified_folds", f"""
WITH u AS (SELECT doc_id, quality, {uniform_sql('42', 'doc_id')} AS u FROM labels),
c AS (SELECT quality, quantile_cont(u, [0.2, 0.4, 0.6, 0.8]) AS cut FROM u GROUP BY 1)
SELECT doc_id, quality, CASE WHEN u > cut[4] THEN 4 WHEN u > cut[3] THEN 3 WHEN u > cut[2] THEN 2
                             WHEN u > cut[1] THEN 1 ELSE 0 END AS fold
FROM u JOIN c USING (quality)""")
def stratified_folds(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return models.stratified_folds(labels, "quality", ["doc_id"])


def _ready(spark, d) -> DataFrame:
    """Labelled documents, stored once because the fits below read them many times."""
    t = text_features(spark, d).withColumnRenamed("quality", "label")
    return cut_lineage(models.add_class_weight(models.stratified_folds(t, "label", ["doc_id"], 3)))


@query("grid_search")
def grid_search(spark, d):
    t = _ready(spark, d)
    est = models.boosted_trees_classifier(TEXT, trees=3)
    found = models.grid_search(est, models.boosted_grid(est, {"depth": [2, 3]}), t, folds=3)
    return models.score(found.bestModel, t.select("doc_id", "label", *TEXT))


RULE_SQL = f"""
WITH {TEXT_SQL} SELECT doc_id, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS label,
       CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS predicted FROM tf"""


def _by_rule(spark, d, plan) -> DataFrame:
    """Labels that are a rule of one column must come back from a full fit."""
    t = cut_lineage(text_features(spark, d).withColumn("label", (F.col("n_chars") > 1500).cast("int")))
    scored = models.score(plan.fit(t), t.select("doc_id", "label", *TEXT))
    return scored.select("doc_id", "label", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("boosted_trees_classifier", RULE_SQL)
def boosted_trees_classifier(spark, d):
    return _by_rule(spark, d, models.boosted_trees_classifier(TEXT))


@query("random_forest_classifier", RULE_SQL)
def random_forest_classifier(spark, d):
    return _by_rule(spark, d, models.random_forest_classifier(TEXT, columns="all"))


@query("balanced_logistic", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 0.0::DOUBLE AS gradient" for c in TEXT))
def balanced_logistic(spark, d):
    """The weighted gradient of the fit per standardized feature, which is 0 at the optimum."""
    t = _ready(spark, d)
    scored = models.score(models.balanced_logistic(TEXT).fit(t), t)
    stats = column_stats(t, TEXT, ["mean", "std"])
    error = F.col("weight") * (F.col("score") - F.col("label"))
    sums = scored.agg(*[
        (F.sum(error * (F.col(c) - stats[c]["mean"]) / (stats[c]["std"] or 1.0)) / F.sum("weight")).alias(c)
        for c in TEXT])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (F.round(c, 3) + 0.0).alias("gradient"))
                                for c in TEXT]))
    return sums.select(cells.alias("_c")).select("_c.*")


@query("class_weights", """
SELECT doc_id, quality, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER
       (PARTITION BY quality)), 9) AS weight FROM labels""")
def class_weights(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return rounded(models.add_class_weight(labels, "quality"), 9, "weight")


SCORED_SQL = f"""{TEXT_SQL}, scored AS (
  SELECT doc_id, quality AS label, n_chars / (n_chars + {CUT}) AS s_chars,
         n_words / (n_words + 200.0) AS s_words, n_digits / (n_digits + 10.0) AS s_digits FROM tf)"""
SCORES = ["s_chars", "s_words", "s_digits"]


def scored(spark, d) -> DataFrame:
    return text_features(spark, d).select(
        "doc_id", F.col("quality").alias("label"),
        (F.col("n_chars") / (F.col("n_chars") + CUT)).alias("s_chars"),
        (F.col("n_words") / (F.col("n_words") + 200.0)).alias("s_words"),
        (F.col("n_digits") / (F.col("n_digits") + 10.0)).alias("s_digits"))


@query("soft_vote", f"""
WITH {SCORED_SQL}
SELECT doc_id, round((s_chars + s_words + s_digits) / 3, 9) AS vote_score,
       CASE WHEN (s_chars + s_words + s_digits) / 3 >= 0.5 THEN 1 ELSE 0 END AS vote FROM scored""")
def soft_vote(spark, d):
    v = models.vote(scored(spark, d), SCORES)
    return rounded(v.select("doc_id", "vote_score", "vote"), 9, "vote_score")


def metrics_sql(s: str) -> str:
    """AUC from the rank sum with mean ranks for ties."""
    return f"""
SELECT '{s}' AS model, count(*) AS n_rows,
       round((sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0)
             / (sum(label) * (count(*) - sum(label))), 9) AS auc,
       round(coalesce(2.0 * sum(CASE WHEN label = 1 AND s >= 0.5 THEN 1 ELSE 0 END)
             / (sum(label) + sum(CASE WHEN s >= 0.5 THEN 1 ELSE 0 END)), 0), 9) AS f1,
       round(coalesce(sum(CASE WHEN label = 1 AND s >= 0.5 THEN 1.0 ELSE 0 END)
             / nullif(sum(CASE WHEN s >= 0.5 THEN 1 ELSE 0 END), 0), 0), 9) AS precision,
       round(sum(CASE WHEN label = 1 AND s >= 0.5 THEN 1.0 ELSE 0 END) / sum(label), 9) AS recall
FROM (SELECT label, {s} AS s, rank() OVER (ORDER BY {s})
             + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0 AS r FROM scored)"""


METRICS_SQL = " UNION ALL ".join(map(metrics_sql, SCORES))
METRICS = ["auc", "f1", "precision", "recall"]


def metrics(spark, d) -> DataFrame:
    return models.metrics_of_scores(scored(spark, d), SCORES)


@query("binary_metrics", f"WITH {SCORED_SQL} {METRICS_SQL}")
def binary_metrics(spark, d):
    return rounded(metrics(spark, d), 9, *METRICS)


@query("roc_points", f"""
WITH {SCORED_SQL},
t AS (SELECT sum(label) AS p, count(*) - sum(label) AS n FROM scored),
s AS (SELECT s_chars AS threshold, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY 1)
SELECT threshold, round(sum(s.n) OVER w / any_value(t.n) OVER (), 9) AS fpr,
       round(sum(s.p) OVER w / any_value(t.p) OVER (), 9) AS tpr
FROM s, t WINDOW w AS (ORDER BY threshold DESC)""")
def roc_points(spark, d):
    return rounded(models.roc_points(scored(spark, d), "label", "s_chars"), 9, "fpr", "tpr")


@query("best_model", f"""
WITH {SCORED_SQL} SELECT model, n_rows, auc, f1, precision, recall FROM ({METRICS_SQL})
ORDER BY auc DESC, model LIMIT 1""")
def best_model(spark, d):
    return rounded(models.best_model(metrics(spark, d)), 9, *METRICS)


_WEIGHTS = {"l_quantity": 0.5, "l_discount": -20.0, "l_tax": 30.0}


@query("linear_importance", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(abs({w} * ({c} - m))), 6) AS importance "
    f"FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)" for c, w in _WEIGHTS.items()))
def linear_importance(spark, d):
    return rounded(models.linear_importance(table(spark, d, "lineitem"), _WEIGHTS), 6, "importance")


@query("shuffle_importance")
def shuffle_importance(spark, d):
    t = _ready(spark, d)
    fitted = models.random_forest_classifier(TEXT, trees=10, depth=4).fit(t)
    return models.shuffle_importance(fitted, t, TEXT, ["doc_id"])


@query("feature_importance")
def feature_importance(spark, d):
    t = _ready(spark, d)
    return models.feature_importance(models.balanced_logistic(TEXT).fit(t), t, TEXT)


@query("tree_contributions", """
WITH t AS (SELECT l_extendedprice AS y, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS large FROM lineitem),
g AS (SELECT large, avg(y) AS m, count(*) AS n FROM t GROUP BY large)
SELECT 'large' AS feature, round(sum(n * abs(m - (SELECT avg(y) FROM t))) / sum(n), 4) AS importance FROM g
UNION ALL SELECT 'returned', 0.0::DOUBLE""")
def tree_contributions(spark, d):
    """One tree of one split: the mean absolute contribution of the column that it splits, and of the one it does not."""
    t = cut_lineage(table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") > 25).cast("int").alias("large"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned")))
    fitted = models.boosted_trees_regressor(["large", "returned"], trees=1, depth=1).fit(t)
    return rounded(contribution_importance(fitted, t, ["large", "returned"]), 4, "importance")


@query("expanding_folds", f"""
WITH r AS (SELECT o_orderkey, o_orderdate, count(*) OVER () AS n,
             row_number() OVER (ORDER BY o_orderdate, {uniform_sql('42', 'o_orderkey')}) - 1 AS i
           FROM orders)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CAST(CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END
            AS INTEGER) AS test_fold FROM r""")
def expanding_folds(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return models.expanding_folds(o, "o_orderdate", ["o_orderkey"]).select(
        "o_orderkey", day("o_orderdate"), "test_fold")


def stays(spark, d) -> DataFrame:
    """Orders as stays: the target is the amount per day of the month."""
    return table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", F.month("o_orderdate").alias("month"),
        F.weekday("o_orderdate").alias("weekday"), "o_custkey",
        (F.col("o_totalprice") / 1000.0).alias("stay"))


@query("boosted_trees_regressor")
def boosted_trees_regressor(spark, d):
    run = train_stay_model(stays(spark, d), ["month", "weekday", "o_custkey"], "stay",
                           "o_orderdate", ["o_orderkey"], trees=3, depth=3)
    return run.folds


STAY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("forecast_stays", f"""
WITH s AS (SELECT *, least(o_orderdate, l_shipdate) AS a, greatest(o_orderdate, l_shipdate) AS b
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT l_returnflag, o_orderpriority, CAST(floor((epoch_us(b) - epoch_us(a)) / 86400000000) AS DOUBLE) AS y,
        CASE WHEN isodow(a) >= 6 THEN 1 ELSE 0 END AS w, count(*) OVER () AS n,
        row_number() OVER (ORDER BY a, {uniform_sql('42', *STAY)}) - 1 AS i FROM s),
f AS (SELECT *, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS fold FROM t),
m AS (SELECT k, l_returnflag, w, avg(y) AS e FROM f JOIN (SELECT unnest(range(1, 6)) AS k) ON fold < k GROUP BY ALL),
r AS (SELECT fold, y, e FROM f JOIN m ON fold = k AND f.l_returnflag = m.l_returnflag AND f.w = m.w),
u AS (SELECT o_orderpriority, least(avg(y) / (1000.0 + 100 * length(o_orderpriority)), 1) AS u FROM t GROUP BY 1)
SELECT 'mae' AS result, CAST(fold AS VARCHAR) AS item, round(avg(abs(y - e)), 6) AS value FROM r GROUP BY fold
UNION ALL SELECT 'r2', CAST(fold AS VARCHAR), round(1 - avg((y - e) * (y - e)) / var_pop(y), 6) FROM r GROUP BY fold
UNION ALL SELECT CASE WHEN u > 0.85 THEN 'overload' WHEN u > 0.7 THEN 'high' ELSE 'normal' END, o_orderpriority, round(u, 6) FROM u
UNION ALL SELECT 'importance', 'all', 1.0::DOUBLE""")
def forecast_stays(spark, d):
    """Order and shipping as the two ends of a stay, in whichever order they come.

    With a category of three values and the weekend flag a tree of full depth has a leaf for each of the six
    combinations, so its estimate is their mean and later trees find nothing left.
    """
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    items = table(spark, d, "lineitem").select(*STAY, "l_returnflag", "l_shipdate")
    ends = lookup_join(items, orders, ["l_orderkey"], "inner").select(
        *STAY, "l_returnflag", "o_orderpriority", F.least("o_orderdate", "l_shipdate").alias("admitted"),
        F.greatest("o_orderdate", "l_shipdate").alias("discharged"))
    wards = table(spark, d, "orders").select("o_orderpriority").distinct().select(
        "o_orderpriority", F.lit(1.0).alias("demand"), F.lit(1.0).alias("factor"),
        (F.lit(1000.0) + 100 * F.length("o_orderpriority")).alias("capacity"))
    found = admissions.forecast_stays(
        ends, "admitted", "discharged", STAY, {"l_returnflag": "flag_code"}, [], wards, "o_orderpriority",
        calendar=["is_weekend"], trees=3)
    folds, text = found.run.folds, F.col("test_fold").cast("string")
    return rounded(reduce(DataFrame.unionByName, [
        folds.select(F.lit("mae").alias("result"), text.alias("item"), F.col("mae").alias("value")),
        folds.select(F.lit("r2").alias("result"), text.alias("item"), F.col("r2").alias("value")),
        found.load.select(F.col("state").alias("result"), F.col("o_orderpriority").alias("item"), F.col("utilization").alias("value")),
        found.top.agg(F.sum("importance").alias("value")).select(F.lit("importance").alias("result"), F.lit("all").alias("item"), "value"),
    ]), 6, "value")


@query("regression_metrics", """
WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500.0 AS e FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(avg(abs(y - e)), 4) AS mae,
       round(avg(abs(y - e) / greatest(abs(y), 2.220446049250313e-16)), 6) AS mape,
       round(1 - avg((y - e) * (y - e)) / var_pop(y), 6) AS r2 FROM p GROUP BY 1""")
def regression_metrics(spark, d):
    t = table(spark, d, "lineitem").withColumn("estimate", F.col("l_quantity") * 1500.0)
    m = models.regression_metrics(t, "l_extendedprice", "estimate", ["l_returnflag"])
    return rounded(rounded(m, 4, "mae"), 6, "mape", "r2")


@query("score_external")
def score_external(spark, d):
    t = _ready(spark, d)
    fitted = models.balanced_logistic(TEXT).fit(t)
    other = table(spark, d, "conversations").select(
        "conv_id", "turn", F.length("text").alias("chars"),
        F.size(F.split("text", " ")).alias("words"), F.lit(0).alias("n_digits"),
        F.lit(2).alias("n_lang"))
    return models.score_external(fitted, other, TEXT,
                                 {"n_chars": "chars", "n_words": "words"}).summary


LONG_ENGLISH = ["steps", "english"]
LONG_ENGLISH_SQL = f"""le AS (
  SELECT doc_id, least(floor(coalesce(n_chars, 0) / 500.0), 8) AS steps, coalesce(lang = 'en', false) AS english,
         {uniform_sql('42', 'doc_id')} AS u FROM documents),
lab AS (SELECT le.*, CASE WHEN steps >= 3 AND english THEN 1 ELSE 0 END AS label FROM le JOIN labels USING (doc_id))"""


def _long_english(docs: DataFrame) -> DataFrame:
    """Two features and a label that needs both of them: one split cannot tell it, two can."""
    steps = F.least(F.floor(F.coalesce(F.col("n_chars"), F.lit(0)) / 500.0), F.lit(8)).cast("double")
    english = F.coalesce(F.col("lang") == "en", F.lit(False)).cast("double")
    named = docs.select("doc_id", steps.alias("steps"), english.alias("english"))
    return named.withColumn("label", ((F.col("steps") >= 3) & (F.col("english") == 1)).cast("int"))


def _labelled(spark, d) -> DataFrame:
    docs = _long_english(table(spark, d, "documents"))
    return cut_lineage(models.stratified_folds(table(spark, d, "labels").select("doc_id").join(docs, "doc_id"), "label", ["doc_id"], 3))


@query("grid_search_choice", f"""
WITH {LONG_ENGLISH_SQL} SELECT doc_id, label, label AS predicted, 2 AS depth FROM lab""")
def grid_search_choice(spark, d):
    """The search must take the deeper of two settings, whose refit then tells every row."""
    t = _labelled(spark, d)
    est = models.boosted_trees_classifier(LONG_ENGLISH, trees=1)
    found = models.grid_search(est, models.boosted_grid(est, {"depth": [1, 2]}), t, folds=3)
    scored = models.score(found.bestModel, t.select("doc_id", "label", *LONG_ENGLISH))
    return scored.select("doc_id", "label", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.lit(found.bestModel.stages[-1].getMaxDepth()).alias("depth"))


@query("score_external_share", f"""
WITH {LONG_ENGLISH_SQL} SELECT count(*) AS n, count(*) FILTER (WHERE steps >= 3 AND english) AS n_high,
       round(avg(CASE WHEN steps >= 3 AND english THEN 1.0 ELSE 0.0 END), 9) AS high_share FROM le""")
def score_external_share(spark, d):
    """A model of the labelled documents on all documents, whose columns have other names."""
    fitted = models.boosted_trees_classifier(LONG_ENGLISH, trees=1, depth=2).fit(_labelled(spark, d))
    other = _long_english(table(spark, d, "documents")).select("doc_id", F.col("steps").alias("half_kilos"), F.col("english").alias("is_en"))
    found = models.score_external(fitted, other, LONG_ENGLISH, {"steps": "half_kilos", "english": "is_en"})
    return rounded(found.summary, 9, "high_share")


@query("shuffle_importance_share", f"""
WITH {LONG_ENGLISH_SQL},
b AS (SELECT *, floor(u * (count(*) OVER () // {ROWS_PER_BUCKET} + 1)) AS b FROM lab),
n AS (SELECT *, coalesce(lead(steps) OVER w, first_value(steps) OVER w) AS s2,
             coalesce(lead(english) OVER w, first_value(english) OVER w) AS e2 FROM b WINDOW w AS (PARTITION BY b ORDER BY u, doc_id))
SELECT 'steps' AS feature, round(tanh(1.0) * avg(CASE WHEN (s2 >= 3 AND english) <> (label = 1) THEN 1.0 ELSE 0.0 END), 6) AS importance FROM n
UNION ALL
SELECT 'english', round(tanh(1.0) * avg(CASE WHEN (steps >= 3 AND e2) <> (label = 1) THEN 1.0 ELSE 0.0 END), 6) FROM n""")
def shuffle_importance_share(spark, d):
    """One tree with leaves of one label scores 1 / (1 + exp(-2)) or one less that: a flip changes it by tanh(1)."""
    t = _labelled(spark, d)
    fitted = models.boosted_trees_classifier(LONG_ENGLISH, trees=1, depth=2).fit(t)
    return rounded(models.shuffle_importance(fitted, t, LONG_ENGLISH, ["doc_id"]), 6, "importance")


@query("save_and_load_model", "SELECT count(*) AS n, 0.0::DOUBLE AS largest_change FROM labels JOIN documents USING (doc_id)")
def save_and_load_model(spark, d):
    """Rows, and the largest change of a score by saving and loading, which is none."""
    t = _ready(spark, d)
    path = scratch_path(spark, "model")
    fitted = models.random_forest_classifier(TEXT).fit(t)
    models.save_model(fitted, path)
    both = models.score(models.load_model(spark, path), models.score(fitted, t, into="before"), into="after")
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_change"))


@query("train_risk_models")
def risk_models(spark, d):
    run = train_risk_models(text_features(spark, d), TEXT, "quality", ["doc_id"], grid={"trees": [3], "depth": [3]},
                            weighted_grid={"trees": [3], "depth": [3], "leaves": [4, 15]}, forest_trees=10,
                            forest_depth=4, folds=3)
    return run.metrics
