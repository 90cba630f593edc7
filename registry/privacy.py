from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from medlark.functions.storage import scratch_path
from medlark.operators import privacy
from medlark.operators.privacy import Release
from medlark.plans.protection import protect_table as protect_plan
from registry.base import query, rounded, table, uniform_sql

SALT = "release-1"


def noise_sql(scale: float, *keys: str) -> str:
    u = uniform_sql(SALT, *keys)
    return f"(-{scale} * sign({u} - 0.5) * ln(1.0 - 2.0 * abs({u} - 0.5)))"


@query("pseudonymize", """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, substr(sha256(c_name), 1, 16) AS c_name_hash
FROM customer""")
def pseudonymize(spark, d):
    return privacy.pseudonymize(table(spark, d, "customer"))


@query("laplace_noise", f"""
SELECT o_orderkey, round(o_totalprice + {noise_sql(1.0, 'o_orderkey', "'o_totalprice'")}, 6)
       AS o_totalprice FROM orders""")
def laplace_noise(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rounded(privacy.laplace_noise(o, ["o_totalprice"], ["o_orderkey"], SALT), 6, "o_totalprice")


@query("noise_report", f"""
SELECT 'o_totalprice' AS column_name, round(avg(x), 6) + 0.0 AS noise_mean,
       round(stddev_pop(x), 6) AS noise_std
FROM (SELECT {noise_sql(1.0, 'o_orderkey', "'o_totalprice'")} AS x FROM orders)""")
def noise_report(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    r = privacy.noise_report(o, ["o_totalprice"], ["o_orderkey"], SALT)
    return rounded(r, 6, "noise_mean", "noise_std")


@query("dp_aggregate", f"""
SELECT n_name, round(n + {noise_sql(2.0, 'n_name', "'people'")}, 4) AS people,
       round(s + {noise_sql(20000.0, 'n_name', "'balance'")}, 2) AS balance
FROM (SELECT n_name, count(*) AS n, sum(least(greatest(c_acctbal, -1000.0), 10000.0)) AS s
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)""")
def dp_aggregate(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    people = table(spark, d, "customer").join(nation, "c_nationkey")
    noisy = privacy.dp_aggregate(people, ["n_name"], {
        "people": Release("count"),
        "balance": Release("sum", "c_acctbal", -1000.0, 10000.0)}, SALT)
    return rounded(rounded(noisy, 4, "people"), 2, "balance")


@query("dp_bounded", f"""
WITH drawn AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {uniform_sql(SALT, 'event_id')}, event_id) AS turn FROM events)
SELECT event_type, round(n + {noise_sql(6.0, 'event_type', "'events'")}, 4) AS events,
       round(s + {noise_sql(600.0, 'event_type', "'value'")}, 2) AS value
FROM (SELECT event_type, count(*) AS n, sum(least(greatest(value, 0.0), 100.0)) AS s FROM drawn WHERE turn <= 3 GROUP BY 1)""")
def dp_bounded(spark, d):
    """At most three events of a user count, and the release is charged to a ledger."""
    ledger = privacy.Ledger(spark, scratch_path(spark, "ledger"), 1.0)
    noisy = privacy.dp_aggregate(
        table(spark, d, "events"), ["event_type"], {"events": Release("count"), "value": Release("sum", "value", 0.0, 100.0)},
        SALT, person=["user_id"], most_rows=3, key=["event_id"], ledger=ledger)
    return rounded(rounded(noisy, 4, "events"), 2, "value")


def _customers(spark, d):
    return table(spark, d, "customer").withColumn("solvent", (F.col("c_acctbal") > 0).cast("int"))


QUASI = ["c_nationkey", "c_mktsegment", "solvent"]
GROUPS_SQL = """c AS (SELECT *, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS solvent FROM customer)"""


@query("k_anonymity", f"""
WITH {GROUPS_SQL}
SELECT min(n) AS k_min, round(avg(n), 6) AS k_mean, count(*) AS n_groups,
       count(*) FILTER (WHERE n < 5) AS n_violations
FROM (SELECT count(*) AS n FROM c GROUP BY c_nationkey, c_mktsegment, solvent)""")
def k_anonymity(spark, d):
    return rounded(privacy.k_anonymity(_customers(spark, d), QUASI), 6, "k_mean")


@query("k_violations", f"""
WITH {GROUPS_SQL}
SELECT c_nationkey, c_mktsegment, solvent, count(*) AS size FROM c
GROUP BY ALL HAVING count(*) < 5""")
def k_violations(spark, d):
    return privacy.k_violations(_customers(spark, d), QUASI)


@query("age_bands", """
SELECT p_partkey, CASE WHEN p_size <= 18 THEN '<18' WHEN p_size <= 30 THEN '18-29'
  WHEN p_size <= 40 THEN '30-39' WHEN p_size <= 50 THEN '40-49' WHEN p_size <= 60 THEN '50-59'
  WHEN p_size <= 70 THEN '60-69' WHEN p_size <= 80 THEN '70-79' ELSE '80+' END AS p_size_group
FROM part""")
def age_bands(spark, d):
    return privacy.age_bands(table(spark, d, "part").select("p_partkey", "p_size"), "p_size")


@query("quantile_bands", """
WITH q AS (SELECT quantile_cont(c_acctbal, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM customer)
SELECT c_custkey, CASE
  WHEN c_acctbal <= e[2] THEN '(' || round(round(e[1], 3) - 0.001, 3) || ', ' || round(e[2], 3) || ']'
  WHEN c_acctbal <= e[3] THEN '(' || round(e[2], 3) || ', ' || round(e[3], 3) || ']'
  WHEN c_acctbal <= e[4] THEN '(' || round(e[3], 3) || ', ' || round(e[4], 3) || ']'
  WHEN c_acctbal <= e[5] THEN '(' || round(e[4], 3) || ', ' || round(e[5], 3) || ']'
  ELSE '(' || round(e[5], 3) || ', ' || round(e[6], 3) || ']' END AS c_acctbal_bin
FROM customer, q""")
def quantile_bands(spark, d):
    return privacy.quantile_bands(
        table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


_PART_NOISE = {c: noise_sql(1.0, "p_partkey", f"'{c}'") for c in ("p_size", "p_retailprice")}


@query("utility_report", f"""
WITH n AS (SELECT p_size AS a, p_retailprice AS b, p_size + {_PART_NOISE['p_size']} AS a2,
                  p_retailprice + {_PART_NOISE['p_retailprice']} AS b2 FROM part)
SELECT 'ok' AS status, round(abs(corr(a, b) - corr(a2, b2)), 6) AS correlation_mae,
       round((abs(avg(a) - avg(a2)) + abs(avg(b) - avg(b2))) / 2, 4) AS avg_mean_diff,
       round((abs(stddev_samp(a) - stddev_samp(a2)) + abs(stddev_samp(b) - stddev_samp(b2))) / 2, 4)
         AS avg_std_diff, CAST(2 AS BIGINT) AS n_columns FROM n""")
def utility_report(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    cols = ["p_size", "p_retailprice"]
    noisy = privacy.laplace_noise(part, cols, ["p_partkey"], SALT)
    r = privacy.utility_report(part, noisy, cols)
    return rounded(rounded(r, 6, "correlation_mae"), 4, "avg_mean_diff", "avg_std_diff")


@query("enforce_k", f"""
WITH {GROUPS_SQL}
SELECT c_custkey, c_nationkey, c_mktsegment, solvent FROM c
QUALIFY count(*) OVER (PARTITION BY c_nationkey, c_mktsegment, solvent) >= 5""")
def enforce_k(spark, d):
    return privacy.enforce_k(
        _customers(spark, d).select("c_custkey", "c_nationkey", "c_mktsegment", "solvent"), QUASI)


@query("protect_table", f"""
WITH c AS (
  SELECT substr(sha256('{SALT}' || c_custkey), 1, 16) AS c_custkey_hash, c_mktsegment,
         substr(sha256('{SALT}' || c_name), 1, 16) AS c_name_hash,
         CASE WHEN c_nationkey <= 18 THEN '<18' ELSE '18-29' END AS c_nationkey_group,
         c_acctbal FROM customer),
q AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS e FROM c),
b AS (SELECT c.*, CASE WHEN c_acctbal <= e[1] THEN 1 WHEN c_acctbal <= e[2] THEN 2
                       WHEN c_acctbal <= e[3] THEN 3 WHEN c_acctbal <= e[4] THEN 4 ELSE 5 END AS band
      FROM c, q),
g AS (SELECT *, count(*) OVER (PARTITION BY c_nationkey_group, c_mktsegment, band) AS n FROM b)
SELECT c_custkey_hash, c_mktsegment, c_name_hash, c_nationkey_group, band,
       (SELECT min(n) FROM g) AS k_before, min(n) OVER () AS k_after FROM g WHERE n >= 20""")
def protect_table(spark, d):
    done = protect_plan(
        table(spark, d, "customer"), id_cols=["c_name", "c_custkey"],
        quasi_ids=["c_nationkey", "c_mktsegment", "c_acctbal"], ages=["c_nationkey"], k=20, salt=SALT)
    # Bands by number: their labels are their edges in order.
    low = F.regexp_extract("c_acctbal_bin", r"\((.*),", 1).cast("double")
    bands = done.table.select("c_acctbal_bin", low.alias("low")).distinct().select(
        "c_acctbal_bin", F.row_number().over(Window.orderBy("low")).alias("band"))
    return done.table.join(bands, "c_acctbal_bin").select(
        "c_custkey_hash", "c_mktsegment", "c_name_hash", "c_nationkey_group", "band",
        F.lit(done.k_before.first()["k_min"]).cast("long").alias("k_before"),
        F.lit(done.k_after.first()["k_min"]).cast("long").alias("k_after"))
