from __future__ import annotations

from pyspark.sql import functions as F

from medlark.operators import reports
from registry.base import query, rounded, table
from registry.models import METRICS_SQL, SCORED_SQL, metrics
from registry.series import daily
from registry.sources import AUDIT_SQL, audit_table
from registry.sql import DAILY_SQL


@query("model_scorecard", f"""
WITH {SCORED_SQL}
SELECT model, auc, f1, n_rows, CASE WHEN auc > 0.8 THEN 'good' ELSE 'improve' END AS verdict
FROM ({METRICS_SQL})""")
def model_scorecard(spark, d):
    return rounded(reports.model_scorecard(metrics(spark, d)), 9, "auc", "f1")


@query("risk_bands", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 < 0.5 OR l_discount * 10 > 1.0 THEN 'outside'
  WHEN l_discount * 10 < 0.7 THEN 'poor' WHEN l_discount * 10 < 0.8 THEN 'fair'
  WHEN l_discount * 10 < 0.85 THEN 'good' ELSE 'very good' END AS band FROM lineitem""")
def risk_bands(spark, d):
    t = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("share"))
    return reports.risk_bands(t, "share").drop("share")


@query("utilization", """
SELECT l_suppkey, round(m, 6) AS mean_load, round(least(m / (c * 0.5), 1), 6) AS utilization,
       CASE WHEN least(m / (c * 0.5), 1) > 0.85 THEN 'overload'
            WHEN least(m / (c * 0.5), 1) > 0.7 THEN 'high' ELSE 'normal' END AS state
FROM (SELECT l_suppkey, avg(l_quantity) AS m FROM lineitem GROUP BY 1)
JOIN (SELECT s_suppkey, 50.0 + s_suppkey % 40 AS c FROM supplier) ON s_suppkey = l_suppkey""")
def utilization(spark, d):
    capacity = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.lit(1.0).alias("demand"),
        (F.lit(50.0) + F.col("s_suppkey") % 40).alias("capacity"), F.lit(0.5).alias("factor"))
    u = reports.utilization(table(spark, d, "lineitem"), capacity, "l_suppkey", "l_quantity")
    return rounded(u, 6, "mean_load", "utilization")


@query("region_vs_mean", """
WITH r AS (SELECT r_name, avg(c_acctbal) AS risk FROM customer JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT r_name, round(risk, 6) AS risk, round(avg(risk) OVER (), 6) AS overall_mean,
       round(risk - avg(risk) OVER (), 6) + 0.0 AS difference FROM r""")
def region_vs_mean(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name")
    people = table(spark, d, "customer").join(places, "c_nationkey")
    return rounded(reports.region_vs_mean(people, "r_name", "c_acctbal"), 6,
                   "risk", "overall_mean", "difference")


@query("headline_figures", f"""
WITH {SCORED_SQL}, {DAILY_SQL}
SELECT 'best_auc' AS kpi, max(auc) AS value FROM ({METRICS_SQL})
UNION ALL SELECT 'training_rows', CAST(sum(rows_after) AS DOUBLE) FROM ({AUDIT_SQL})
UNION ALL SELECT 'series_points', CAST(count(*) AS DOUBLE) FROM daily
UNION ALL SELECT 'validation_rows', CAST(count(*) AS DOUBLE) FROM conversations""")
def headline_figures(spark, d):
    done = reports.headline_figures(audit_table(spark, d), metrics(spark, d), daily(spark, d),
                                    table(spark, d, "conversations"))
    return rounded(done, 9, "value")
