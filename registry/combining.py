from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.operators import combine
from registry.base import day, query, rounded, table, uniform_sql


def _orders_by_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_custkey").alias("SEQN")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))


@query("merge_surveys", """
WITH demo AS (SELECT c_custkey AS seqn, c_mktsegment AS segment_DEMO FROM customer),
ord AS (SELECT o_custkey AS seqn, count(*) AS n_ORD, max(o_totalprice) AS top_ORD FROM orders
        GROUP BY o_custkey, o_orderdate < TIMESTAMP '1998-01-01'),
nat AS (SELECT c_nationkey AS seqn, count(*) AS people_NAT FROM customer GROUP BY 1)
SELECT coalesce(demo.seqn, ord.seqn, nat.seqn) AS seqn, segment_DEMO, n_ORD, top_ORD, people_NAT
FROM demo FULL JOIN ord ON demo.seqn = ord.seqn
     FULL JOIN nat ON coalesce(demo.seqn, ord.seqn) = nat.seqn""")
def merge_surveys(spark, d):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return combine.merge_surveys({
        "DEMO": customer.select(F.col("c_custkey").alias("SEQN"),
                                F.col("c_mktsegment").alias("segment")),
        "ORD_H": _orders_by_customer(orders.where(early)),
        "ORD_J": _orders_by_customer(orders.where(~early)),
        "NAT": customer.groupBy(F.col("c_nationkey").cast("bigint").alias("seqn")).agg(
            F.count(F.lit(1)).alias("people")),
        "NOKEY": table(spark, d, "region"),
    })


@query("zip_samples", f"""
WITH a AS (SELECT c_custkey, c_acctbal,
             row_number() OVER (ORDER BY {uniform_sql('42', 'c_custkey')}, c_custkey) AS position
           FROM customer),
b AS (SELECT o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY {uniform_sql('42', 'o_orderkey')}, o_orderkey) AS position
      FROM orders)
SELECT position, c_custkey AS people_c_custkey,
       c_acctbal AS people_c_acctbal, o_orderkey AS bills_o_orderkey,
       o_totalprice AS bills_o_totalprice
FROM a JOIN b USING (position)""")
def zip_samples(spark, d):
    return combine.zip_samples(
        {"people": table(spark, d, "customer").select("c_custkey", "c_acctbal"),
         "bills": table(spark, d, "orders").select("o_orderkey", "o_totalprice")},
        {"people": ["c_custkey"], "bills": ["o_orderkey"]})


@query("join_by_respondent", """
SELECT c_custkey AS person, c_mktsegment, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def join_by_respondent(spark, d):
    demo = table(spark, d, "customer").select(F.col("c_custkey").alias("person"), "c_mktsegment")
    health = table(spark, d, "orders").select(
        F.col("o_custkey").alias("person"), "o_orderkey", "o_totalprice")
    return combine.join_by_respondent(demo, health, "person")


def _people(spark, d) -> list[DataFrame]:
    return [
        table(spark, d, "customer").toDF("key", "name", "nationkey", "acctbal", "segment"),
        table(spark, d, "supplier").toDF("key", "name", "nationkey", "acctbal"),
    ]


@query("union_common", """
SELECT c_acctbal AS acctbal, c_custkey AS key, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL SELECT s_acctbal, s_suppkey, s_name, s_nationkey FROM supplier""")
def union_common(spark, d):
    return combine.union_common(_people(spark, d))


@query("union_all_columns", """
SELECT 0 AS n_nationkey, '0' AS n_name, 0 AS n_regionkey, r_name, r_regionkey FROM region
UNION ALL SELECT n_nationkey, n_name, n_regionkey, '0', 0 FROM nation""")
def union_all_columns(spark, d):
    return combine.union_all_columns([table(spark, d, "region"), table(spark, d, "nation")])


@query("dedupe", """
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0)""")
def dedupe(spark, d):
    o = table(spark, d, "orders")
    twice = o.unionByName(o.where(F.col("o_orderkey") % 10 == 0))
    return combine.dedupe(twice).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day("o_orderdate"),
        "o_orderpriority")


@query("removed_duplicates", """
SELECT copies, count(*) AS rows, CAST(sum(copies - 1) AS BIGINT) AS removed FROM (
  SELECT count(*) AS copies FROM (
    SELECT user_id, event_type, date_trunc('day', ts) AS d FROM events) GROUP BY user_id, event_type, d HAVING count(*) > 1)
GROUP BY copies""")
def removed_duplicates(spark, d):
    return combine.removed_duplicates(table(spark, d, "events").select(
        "user_id", "event_type", F.date_trunc("day", "ts").alias("d")))


@query("fuse_domain", """
SELECT 'people' AS domain, 'common_cols' AS method, count(*) AS n_rows, 4 AS n_cols,
       round(avg(acctbal), 6) AS mean_value
FROM (SELECT c_acctbal AS acctbal FROM customer UNION ALL SELECT s_acctbal FROM supplier)
UNION ALL
SELECT 'places', 'all_cols', count(*), 5, round(avg(k), 6)
FROM (SELECT r_regionkey AS k FROM region UNION ALL SELECT 0 FROM nation)
UNION ALL
SELECT 'things', 'single', count(*), 6, round(avg(p_size), 6) FROM part""")
def fuse_domain(spark, d):
    customer, supplier = _people(spark, d)
    fused, methods, _ = combine.fuse_domain(
        {"customer": customer, "supplier": supplier, "part": table(spark, d, "part"),
         "region": table(spark, d, "region"), "nation": table(spark, d, "nation"),
         "orders": table(spark, d, "orders")},
        {"people": ["customer", "supplier"], "places": ["region", "nation", "absent"],
         "things": ["part"], "none": ["absent"]})
    values = {"people": "acctbal", "places": "r_regionkey", "things": "p_size"}
    parts = [
        t.agg(F.lit(domain).alias("domain"), F.lit(methods[domain]).alias("method"),
              F.count(F.lit(1)).alias("n_rows"), F.lit(len(t.columns)).alias("n_cols"),
              F.avg(values[domain]).alias("mean_value"))
        for domain, t in fused.items()
    ]
    return rounded(reduce(DataFrame.unionByName, parts), 6, "mean_value")
