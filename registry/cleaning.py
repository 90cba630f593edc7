from __future__ import annotations

from pyspark.sql import functions as F

from medlark.operators import clean
from medlark.plans.cleaning import clean_table as clean_plan
from registry.base import (
    EVENTS_MASKED, LINEITEM_MASKED, PART_MASKED, events_masked, lineitem_masked, part_masked,
    query, rounded, table,
)

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("impute_median", f"""
WITH {EVENTS_MASKED}
SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM em)) AS value,
       coalesce(sparse, (SELECT quantile_cont(sparse, 0.5) FROM em)) AS sparse FROM em""")
def impute_median(spark, d):
    e = events_masked(spark, d).select("event_id", "value", "sparse")
    return clean.impute_median(e, ["value", "sparse"])


@query("impute_mode", f"""
WITH {EVENTS_MASKED}, top AS (
  SELECT event_type FROM em WHERE event_type IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, coalesce(event_type, (SELECT event_type FROM top)) AS event_type FROM em""")
def impute_mode(spark, d):
    return clean.impute_mode(events_masked(spark, d).select("event_id", "event_type"), ["event_type"])


KNN_SQL = f"""
WITH {PART_MASKED}, far AS (
  SELECT r.p_partkey AS k, o.p_partkey AS ok, o.p_size AS s, o.p_retailprice AS p,
         (coalesce((r.p_size - o.p_size) * (r.p_size - o.p_size), 0)
          + coalesce((r.p_retailprice - o.p_retailprice) * (r.p_retailprice - o.p_retailprice), 0))
         * (2.0 / (CASE WHEN r.p_size IS NULL OR o.p_size IS NULL THEN 0 ELSE 1 END
                   + CASE WHEN r.p_retailprice IS NULL OR o.p_retailprice IS NULL THEN 0 ELSE 1 END))
         AS dist
  FROM pm r JOIN pm o ON r.p_partkey <> o.p_partkey
   AND ((r.p_size IS NOT NULL AND o.p_size IS NOT NULL)
        OR (r.p_retailprice IS NOT NULL AND o.p_retailprice IS NOT NULL))
  WHERE r.p_size IS NULL OR r.p_retailprice IS NULL),
s AS (SELECT k, avg(s) AS v FROM (
  SELECT k, s, row_number() OVER (PARTITION BY k ORDER BY dist, ok) AS rn FROM far
  WHERE s IS NOT NULL) WHERE rn <= 5 GROUP BY k),
p AS (SELECT k, avg(p) AS v FROM (
  SELECT k, p, row_number() OVER (PARTITION BY k ORDER BY dist, ok) AS rn FROM far
  WHERE p IS NOT NULL) WHERE rn <= 5 GROUP BY k)
SELECT p_partkey,
       round(coalesce(p_size, s.v, (SELECT avg(p_size) FROM pm)), 6) AS p_size,
       round(coalesce(p_retailprice, p.v, (SELECT avg(p_retailprice) FROM pm)), 6) AS p_retailprice
FROM pm LEFT JOIN s ON s.k = p_partkey LEFT JOIN p ON p.k = p_partkey"""


@query("impute_knn", KNN_SQL)
def impute_knn(spark, d):
    done = clean.impute_knn(part_masked(spark, d), ["p_size", "p_retailprice"], "p_partkey")
    return rounded(done, 6, "p_size", "p_retailprice")


@query("impute_mice", f"""
WITH {LINEITEM_MASKED}, m AS (
  SELECT var_pop(l_quantity) AS q, var_pop(l_discount) AS d, covar_pop(l_quantity, l_discount) AS qd,
         covar_pop(l_quantity, l_tax) AS qt, covar_pop(l_discount, l_tax) AS dt,
         avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_tax) AS mt
  FROM lm WHERE l_tax IS NOT NULL),
w AS (SELECT *, (qt * d - dt * qd) / (q * d - qd * qd) AS wq,
             (dt * q - qt * qd) / (q * d - qd * qd) AS wd FROM m)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount,
       round(coalesce(l_tax, mt + wq * (l_quantity - mq) + wd * (l_discount - md)), 8) AS l_tax
FROM lm, w""")
def impute_mice(spark, d):
    t = lineitem_masked(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    return rounded(clean.impute_mice(t, ["l_quantity", "l_discount", "l_tax"]), 8, "l_tax")


def _round_sql(k: int, target: str, other: str, gap: str) -> str:
    """One column's regression on ``q`` and the other, over the rows that have it, and its new fills."""
    last = f"f{k - 1}"
    return f"""w{k} AS (
  SELECT avg({target}) AS m, avg(q) AS mq, avg({other}) AS mo,
         (covar_pop(q, {target}) * var_pop({other}) - covar_pop({other}, {target}) * covar_pop(q, {other}))
           / (var_pop(q) * var_pop({other}) - covar_pop(q, {other}) * covar_pop(q, {other})) AS wq,
         (covar_pop({other}, {target}) * var_pop(q) - covar_pop(q, {target}) * covar_pop(q, {other}))
           / (var_pop(q) * var_pop({other}) - covar_pop(q, {other}) * covar_pop(q, {other})) AS wo
  FROM {last} WHERE NOT {gap}),
f{k} AS MATERIALIZED (
  SELECT {last}.* REPLACE (CASE WHEN {gap} THEN m + wq * (q - mq) + wo * ({other} - mo) ELSE {target} END AS {target})
  FROM {last}, w{k})"""


@query("impute_mice_rounds", f"""
WITH lm AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS q,
         CASE WHEN (l_orderkey + l_linenumber) % 8 <> 0 THEN l_extendedprice END AS t,
         CASE WHEN (l_orderkey + l_partkey) % 5 <> 0 THEN l_discount END AS d FROM lineitem),
f0 AS (SELECT l_orderkey, l_linenumber, l_partkey, q, t IS NULL AS no_t, d IS NULL AS no_d,
              coalesce(t, (SELECT avg(t) FROM lm)) AS t, coalesce(d, (SELECT avg(d) FROM lm)) AS d FROM lm),
{_round_sql(1, 't', 'd', 'no_t')}, {_round_sql(2, 'd', 't', 'no_d')},
{_round_sql(3, 't', 'd', 'no_t')}, {_round_sql(4, 'd', 't', 'no_d')}
SELECT l_orderkey, l_linenumber, l_partkey, q AS l_quantity, round(t, 2) AS l_extendedprice, round(d, 6) AS l_discount FROM f4""")
def impute_mice_rounds(spark, d):
    """Two incomplete columns, two rounds of both."""
    t = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 8 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when((F.col("l_orderkey") + F.col("l_partkey")) % 5 != 0, F.col("l_discount")).alias("l_discount"))
    filled = clean.impute_mice(t, ["l_quantity", "l_extendedprice", "l_discount"], iters=2, tol=0.0)
    return rounded(rounded(filled, 2, "l_extendedprice"), 6, "l_discount")


@query("impute_auto", f"""
WITH {LINEITEM_MASKED},
w AS (SELECT covar_pop(l_quantity, l_tax) / var_pop(l_quantity) AS slope, avg(l_quantity) AS mq,
             avg(l_tax) AS mt FROM lm WHERE l_tax IS NOT NULL)
SELECT l_orderkey, l_partkey, l_quantity, round(coalesce(l_tax, mt + slope * (l_quantity - mq)), 8) AS l_tax
FROM lm, w""")
def impute_auto(spark, d):
    t = lineitem_masked(spark, d).select("l_orderkey", "l_partkey", "l_quantity", "l_tax")
    return rounded(clean.impute_auto(t, ["l_quantity", "l_tax"], "mice"), 8, "l_tax")


def _bounds(c: str) -> str:
    return (f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) "
            f"AS {c}_lo, quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) "
            f"- quantile_cont({c}, 0.25)) AS {c}_hi")


@query("winsorize_iqr", f"""
WITH b AS (SELECT {', '.join(map(_bounds, NUMBERS))} FROM lineitem)
SELECT l_orderkey, l_linenumber, {', '.join(
    f'round(least(greatest({c}, {c}_lo), {c}_hi), 6) AS {c}' for c in NUMBERS)}
FROM lineitem, b""")
def winsorize_iqr(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS)
    return rounded(clean.winsorize_iqr(t, NUMBERS), 6, *NUMBERS)


@query("count_clipped", f"""
WITH b AS (SELECT {_bounds('value')} FROM events)
SELECT count(*) FILTER (WHERE value < value_lo OR value > value_hi) AS value FROM events, b""")
def count_clipped(spark, d):
    e = table(spark, d, "events").select("value")
    return clean.count_clipped(e, clean.iqr_bounds(e))


@query("winsorize_zscore", """
WITH b AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
SELECT event_id, round(least(greatest(value, m - 3 * s), m + 3 * s), 6) AS value FROM events, b""")
def winsorize_zscore(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return rounded(clean.winsorize_zscore(e, ["value"]), 6, "value")


@query("encode_binary", """
SELECT l_orderkey, l_linenumber, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS l_linestatus
FROM lineitem""")
def encode_binary(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return clean.encode_binary(t, "l_linestatus")


_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_FLAGS = ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s}"
                   for s in _SEGMENTS)


@query("encode_onehot", f"SELECT c_custkey, {_FLAGS} FROM customer")
def encode_onehot(spark, d):
    return clean.encode_onehot(
        table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query("encode_ordinal", """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand FROM part""")
def encode_ordinal(spark, d):
    return clean.encode_ordinal(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand")


@query("encode_auto", f"""
SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS c_name, {_FLAGS} FROM customer""")
def encode_auto(spark, d):
    return clean.encode_auto(table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit("same").alias("constant")))


def _standard(c: str) -> str:
    return f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 8) + 0.0 AS {c}"


@query("scale_standard", f"SELECT l_orderkey, l_linenumber, {', '.join(map(_standard, NUMBERS))} "
                         "FROM lineitem")
def scale_standard(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS)
    return rounded(clean.scale_standard(t, NUMBERS), 8, *NUMBERS)


def _minmax(c: str) -> str:
    return (f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 9) + 0.0 "
            f"AS {c}")


@query("scale_minmax", f"SELECT l_orderkey, l_linenumber, {', '.join(map(_minmax, NUMBERS))} "
                       "FROM lineitem")
def scale_minmax(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS)
    return rounded(clean.scale_minmax(t, NUMBERS), 9, *NUMBERS)


_MODE = """coalesce(event_type, (SELECT event_type FROM u WHERE event_type IS NOT NULL
                               GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type"""
_FILLS = {
    "median": f"""filled AS (
  SELECT event_id, user_id * 1.0::DOUBLE AS user_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM u)) AS value, {_MODE}
  FROM u)""",
    "mice": f"""w AS (SELECT covar_pop(user_id, value) / var_pop(user_id) AS slope, avg(user_id) AS mu, avg(value) AS mv
  FROM u WHERE value IS NOT NULL),
filled AS (
  SELECT event_id, user_id * 1.0::DOUBLE AS user_id, coalesce(value, mv + slope * (user_id - mu)) AS value, {_MODE} FROM u, w)""",
    "knn": f"""near AS (
  SELECT k, avg(v) AS v FROM (
    SELECT r.event_id AS k, o.value AS v, row_number() OVER (
      PARTITION BY r.event_id ORDER BY (r.user_id - o.user_id) * (r.user_id - o.user_id), o.event_id) AS rn
    FROM u r JOIN u o ON r.value IS NULL AND o.value IS NOT NULL) WHERE rn <= 5 GROUP BY k),
filled AS (
  SELECT event_id, user_id * 1.0::DOUBLE AS user_id, coalesce(value, v) AS value, {_MODE} FROM u LEFT JOIN near ON k = event_id)""",
}


def _zbounds(c: str) -> str:
    return f"avg({c}) - 3 * stddev_samp({c}) AS {c}_lo, avg({c}) + 3 * stddev_samp({c}) AS {c}_hi"


def _standard_of(c: str) -> str:
    return f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}"


def _minmax_of(c: str) -> str:
    return f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}"


def _clean_sql(fill: str, bounds=_bounds, scale=_standard_of) -> str:
    return f"""
WITH {EVENTS_MASKED},
u AS (SELECT event_id, user_id, event_type, value FROM em),
{_FILLS[fill]},
b AS (SELECT {bounds('user_id')}, {bounds('value')} FROM filled),
cut AS (SELECT event_id, event_type,
               CASE WHEN user_id_hi > user_id_lo
                    THEN least(greatest(user_id, user_id_lo), user_id_hi) ELSE user_id END AS user_id,
               CASE WHEN value_hi > value_lo
                    THEN least(greatest(value, value_lo), value_hi) ELSE value END AS value
        FROM filled, b),
done AS (SELECT event_id, event_type, {scale('user_id')}, {scale('value')} FROM cut)
SELECT event_id, round(user_id, 7) + 0.0 AS user_id, round(value, 7) + 0.0 AS value,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event_type_error,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type_purchase,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS event_type_signup,
       CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view
FROM done"""


def messy_events(spark, d):
    e = events_masked(spark, d).select(
        F.col("event_id").alias("Event ID"), F.col("user_id").alias(" User_ID"), "event_type",
        "value", "sparse", "empty", F.lit("same").alias("constant"), F.lit(1).alias("id"))
    return e.unionByName(e.where(F.col("Event ID") % 10 == 0))


def _cleaned(spark, d, **how):
    done = clean_plan(messy_events(spark, d), keep=["event_id"], **how)
    done = rounded(done, 7, "user_id", "value")
    return done.withColumns({c: F.col(c) + F.lit(0.0) for c in ("user_id", "value")})


@query("clean_table", _clean_sql("median"))
def clean_table(spark, d):
    return _cleaned(spark, d, impute="median")


@query("clean_table_mice", _clean_sql("mice", _zbounds))
def clean_table_mice(spark, d):
    return _cleaned(spark, d, impute="mice", outliers="zscore")


@query("clean_table_knn", _clean_sql("knn", _bounds, _minmax_of))
def clean_table_knn(spark, d):
    return _cleaned(spark, d, impute="knn", key="event_id", scaling="minmax")


@query("clean_table_zscore_minmax", _clean_sql("median", _zbounds, _minmax_of))
def clean_table_zscore_minmax(spark, d):
    return _cleaned(spark, d, impute="median", outliers="zscore", scaling="minmax")
