from __future__ import annotations

from pyspark.sql import functions as F

from medlark.functions.joins import lookup_join
from medlark.functions.types import col
from medlark.operators import columns as c
from medlark.operators.profile import distinct_profile
from registry.base import (
    COLUMNS, EVENTS_MASKED, all_tables, day, events_masked, query, table,
)


@query("normalize_names", "SELECT * FROM part")
def normalize_names(spark, d):
    part = table(spark, d, "part")
    return c.normalize_names(part.toDF(*[f" {n.upper().replace('_', ' ')} " for n in part.columns]))


@query("drop_noise_columns", "SELECT * FROM customer")
def drop_noise_columns(spark, d):
    noisy = table(spark, d, "customer").select(
        "*", F.col("c_custkey").alias("id"), F.lit(0).alias("unnamed:_0"))
    return c.drop_noise_columns(noisy)


@query("drop_null_columns", """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""")
def drop_null_columns(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", F.lit(None).cast("string").alias("empty"))
    done = c.drop_null_columns(o)
    return done.select([day(n) if n == "o_orderdate" else col(n) for n in done.columns])


@query("drop_sparse_columns", f"""
WITH {EVENTS_MASKED}
SELECT event_id, user_id, event_type, value, props, at_threshold FROM em""")
def drop_sparse_columns(spark, d):
    return c.drop_sparse_columns(events_masked(spark, d).drop("ts"))


@query("drop_empty_rows", f"""
WITH {EVENTS_MASKED}
SELECT event_type, value FROM em WHERE event_type IS NOT NULL OR value IS NOT NULL""")
def drop_empty_rows(spark, d):
    return c.drop_empty_rows(events_masked(spark, d).select("event_type", "value"))


@query("drop_rows_missing", f"""
WITH {EVENTS_MASKED}
SELECT event_id, event_type, value FROM em WHERE event_type IS NOT NULL AND value IS NOT NULL""")
def drop_rows_missing(spark, d):
    e = events_masked(spark, d).select("event_id", "event_type", "value")
    return c.drop_rows_missing(e, ["event_type", "value"])


@query("filter_contains", """
SELECT p_partkey, p_type FROM part WHERE lower(p_type) LIKE '%m%'""")
def filter_contains(spark, d):
    return c.filter_contains(table(spark, d, "part"), "p_type", "M").select("p_partkey", "p_type")


@query("parse_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END
       AS o_orderdate FROM orders""")
def parse_dates(spark, d):
    text = F.when(F.col("o_orderkey") % 13 == 0, "not a date").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    o = table(spark, d, "orders").select("o_orderkey", text.alias("o_orderdate"))
    return c.parse_dates(o, "o_orderdate").select("o_orderkey", day("o_orderdate"))


def _each_column(select: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS column_name, {select.format(c=n)}, "
        f"count({n}) AS n_values FROM {t}"
        for t, names in COLUMNS.items() for n in names)


_KIND = ("CASE WHEN typeof(any_value({c})) IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', "
         "'FLOAT', 'DOUBLE') THEN 'numeric' ELSE 'other' END AS kind")


@query("split_columns_by_type", _each_column(_KIND))
def split_columns_by_type(spark, d):
    return c.column_kinds(all_tables(spark, d))


@query("pick_value_column", "SELECT event_id, value AS picked FROM events")
def pick_value_column(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", col(c.pick_value_column(e)).alias("picked"))


@query("fill_zero", f"""
WITH {EVENTS_MASKED}
SELECT event_id, event_type, coalesce(value, 0) AS value, coalesce(sparse, 0) AS sparse FROM em""")
def fill_zero(spark, d):
    e = events_masked(spark, d).select("event_id", "event_type", "value", "sparse")
    return c.fill_zero(e, ["value", "sparse"])


@query("recode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
       WHEN '3-MEDIUM' THEN 2 END AS urgency FROM orders""")
def recode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    done = c.recode(o, "o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}, "urgency")
    return done.select("o_orderkey", "urgency")


@query("presence_flag", f"""
WITH {EVENTS_MASKED}
SELECT event_id, CASE WHEN value IS NULL THEN 0 ELSE 1 END AS has_value FROM em""")
def presence_flag(spark, d):
    e = events_masked(spark, d).select("event_id", "value")
    return c.presence_flag(e, "value", "has_value").select("event_id", "has_value")


@query("body_measures", """
SELECT p_partkey, round(p_size / ((p_retailprice / 100.0) * (p_retailprice / 100.0)), 9) AS bmi,
       p_retailprice - p_size AS pulse_pressure FROM part""")
def body_measures(spark, d):
    part = table(spark, d, "part")
    done = c.body_measures(part, "p_size", "p_retailprice", "p_retailprice", "p_size")
    return done.select("p_partkey", F.round("bmi", 9).alias("bmi"), "pulse_pressure")


@query("stay_features", """
SELECT l_orderkey, l_linenumber,
       CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000) AS INTEGER)
         AS los_days,
       CAST(month(o_orderdate) AS INTEGER) AS admission_month,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS admission_weekday,
       CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def stay_features(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    stays = lookup_join(items, orders, ["l_orderkey"], "inner")
    return c.stay_features(stays, "o_orderdate", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "los_days", "admission_month", "admission_weekday",
        "is_weekend")


@query("align_schema", """
SELECT 0 AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal,
       0 AS c_mktsegment FROM supplier""")
def align_schema(spark, d):
    s = table(spark, d, "supplier").toDF("s_key", "c_name", "c_nationkey", "c_acctbal")
    return c.align_schema(s, COLUMNS["customer"], 0)


@query("affix_names", """
SELECT n_nationkey, n_name AS n_name_geo, n_regionkey AS n_regionkey_geo FROM nation""")
def affix_names(spark, d):
    return c.affix_names(table(spark, d, "nation"), suffix="_geo", keep=["n_nationkey"])


@query("detect_label", "SELECT doc_id, 'quality' AS label_name, quality AS label FROM labels")
def detect_label(spark, d):
    labels = table(spark, d, "labels")
    found = c.detect_label(labels, ["outcome", "doc_id", "quality", "toxic"])
    return labels.select("doc_id", F.lit(found).alias("label_name"), col(found).alias("label"))


@query("detect_id_columns", """
SELECT 'customer_id' AS column_name, count(DISTINCT c_custkey) AS n_distinct FROM customer
UNION ALL SELECT 'shown_as', count(DISTINCT c_name) FROM customer""")
def detect_id_columns(spark, d):
    people = table(spark, d, "customer").toDF(
        "customer_id", "shown_as", "nation", "balance", "segment")
    return distinct_profile(people, c.detect_id_columns(people))


_SQUEEZED = "replace(replace(lower(column_name), '_', ''), '-', '')"


@query("detect_quasi_ids", f"""
SELECT table_name, column_name, n_values FROM ({_each_column('1 AS one')})
WHERE regexp_matches({_SQUEEZED}, 'age|sex|gender|race|ethnicity|zip|postal|region|state|country|'
                     || 'education|income|occupation|marital')""")
def detect_quasi_ids(spark, d):
    listed = c.column_catalog(all_tables(spark, d), {"quasi": c.QUASI_ID_WORDS}, "substring")
    return listed.drop("category")


_PATTERNS = ", ".join(
    f"('{cat}', '{w.replace('_', '')}')" for cat, words in c.MEANING_WORDS.items() for w in words)


@query("column_catalog", f"""
SELECT DISTINCT category, table_name, column_name, n_values
FROM ({_each_column('1 AS one')}) JOIN (VALUES {_PATTERNS}) p(category, word)
  ON contains({_SQUEEZED}, word)""")
def column_catalog(spark, d):
    return c.column_catalog(all_tables(spark, d), match="substring")


@query("drop_constant_categories", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_constant_categories(spark, d):
    t = table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit("same").alias("constant"))
    return c.drop_constant_categories(t)
