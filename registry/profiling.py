from __future__ import annotations

from pyspark.sql import functions as F

from medlark.operators import profile, sampling
from medlark.functions.storage import scratch_path
from medlark.sources import writers
from registry.base import EVENTS_MASKED, COLUMNS, all_tables, events_masked, query, rounded, table, uniform_sql
from registry.series import alerts_by_type
from registry.sources import AUDIT_SQL, audit_table
from registry.sql import ALERTS_SQL

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _missing(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
            f"round((count(*) - count({c})) / count(*), 9) AS missing_share FROM em")


_MASKED = ["event_id", "user_id", "event_type", "value", "sparse", "empty", "at_threshold"]


@query("missing_profile", f"WITH {EVENTS_MASKED} " + " UNION ALL ".join(map(_missing, _MASKED)))
def missing_profile(spark, d):
    return rounded(profile.missing_profile(events_masked(spark, d).select(*_MASKED)), 9,
                   "missing_share")


@query("distinct_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lineitem"
    for c in COLUMNS["lineitem"]))
def distinct_profile(spark, d):
    return profile.distinct_profile(table(spark, d, "lineitem"))


def _numbers(c: str) -> str:
    return f"""
SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS min, max({c}) AS max,
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(var_samp({c}), 1) AS var, round(skewness({c}), 6) + 0.0 AS skew,
       quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
       quantile_cont({c}, 0.75) AS q3 FROM lineitem"""


@query("numeric_profile", " UNION ALL ".join(map(_numbers, NUMBERS)))
def numeric_profile(spark, d):
    p = profile.numeric_profile(table(spark, d, "lineitem"), NUMBERS)
    return rounded(rounded(rounded(p, 4, "mean", "std"), 1, "var"), 6, "skew")


def _mode(c: str) -> str:
    return f"""
SELECT '{c}' AS column_name, v AS mode_value FROM (
  SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"""


@query("mode_of", " UNION ALL ".join(
    f"SELECT * FROM ({_mode(c)})" for c in ("o_orderstatus", "o_orderpriority")))
def mode_of(spark, d):
    return profile.mode_of(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("label_rate", """
SELECT lang, count(quality) AS n, round(avg(quality), 9) AS rate
FROM labels JOIN documents USING (doc_id) GROUP BY lang""")
def label_rate(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    labelled = table(spark, d, "labels").join(docs, "doc_id")
    return rounded(profile.label_rate(labelled, "quality", ["lang"]), 9, "rate")


CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) + 0.0 AS r FROM lineitem"
    for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:])


@query("corr_matrix", CORR_SQL)
def corr_matrix(spark, d):
    return rounded(profile.corr_matrix(table(spark, d, "lineitem"), NUMBERS), 9, "r")


@query("group_size_profile", """
SELECT count(*) AS n_groups, min(n) AS size_min, round(avg(n), 6) AS size_mean,
       count(*) FILTER (WHERE n < 5) AS n_below_k
FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment, c_acctbal > 0)""")
def group_size_profile(spark, d):
    p = profile.group_size_profile(
        table(spark, d, "customer"),
        ["c_nationkey", "c_mktsegment", (F.col("c_acctbal") > 0).alias("solvent")])
    return rounded(p, 6, "size_mean")


@query("histogram", """
WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
b AS (SELECT CAST(least(floor((l_quantity - lo) * 30.0 / (hi - lo)), 29) AS INTEGER) AS bin,
             count(*) AS n FROM lineitem, s GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / 30), 9) AS lo,
       round(lo + (i + 1) * ((hi - lo) / 30), 9) AS hi, coalesce(n, 0) AS n
FROM range(30) r(i) CROSS JOIN s LEFT JOIN b ON b.bin = i""")
def histogram(spark, d):
    return rounded(profile.histogram(table(spark, d, "lineitem"), "l_quantity"), 9, "lo", "hi")


@query("audit_rollup", f"""
SELECT status, count(*) AS n_tables, CAST(sum(rows_after) AS BIGINT) AS total_rows,
       CAST(sum(cols_after) AS BIGINT) AS total_cols, 0.0::DOUBLE AS total_kb,
       avg(missing_rate) AS mean_missing_rate
FROM ({AUDIT_SQL}) GROUP BY status""")
def audit_rollup(spark, d):
    return profile.audit_rollup(audit_table(spark, d))


@query("largest_tables", f"""
SELECT table_name, rows_after, cols_after, 1::BIGINT AS stored FROM ({AUDIT_SQL})
ORDER BY rows_after DESC, table_name LIMIT 5""")
def largest_tables(spark, d):
    """Stored copies of all tables, audited with the sizes of their files; sizes differ by writer, so the row shows that there is one."""
    out, run = scratch_path(spark, "stored"), "run"
    rows = []
    for name, df in all_tables(spark, d).items():
        writers.write_parquet(df, f"{out}/{name}")
        rows.append(writers.audit_row(spark.read.parquet(f"{out}/{name}"), name, run, path=f"{out}/{name}"))
    writers.append_audit(spark, f"{out}/audit", rows)
    top = profile.largest_tables(spark.read.parquet(f"{out}/audit"), 5)
    return top.select("table_name", "rows_after", "cols_after", (F.col("size_kb") > 0).cast("long").alias("stored"))


@query("anomaly_summary", f"""
WITH {ALERTS_SQL} SELECT event_type, type, count(*) AS n FROM alerts GROUP BY 1, 2""")
def anomaly_summary(spark, d):
    return profile.anomaly_summary(alerts_by_type(spark, d), ["event_type"])


@query("top_features", f"""
SELECT a || '~' || b AS feature, abs(r) AS importance FROM ({CORR_SQL})
ORDER BY importance DESC, feature LIMIT 3""")
def top_features(spark, d):
    r = corr_matrix(spark, d)
    named = r.select(F.concat_ws("~", "a", "b").alias("feature"), F.abs("r").alias("importance"))
    return sampling.top_features(named, 3)


@query("sample_rows", f"""
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY {uniform_sql('42', 'o_orderkey')}, o_orderkey LIMIT 500""")
def sample_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_rows(o, 500, ["o_orderkey"])
