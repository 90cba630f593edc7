"""Registration, table access and the masked inputs shared by the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medlark.functions.types import col, replace_columns
from medlark.sources.readers import read_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
COLUMNS = {t: c.split() for t, c in COLUMNS.items()}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir); ``sql`` is the same query for the check."""
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{d}/{name}.parquet")


def all_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: table(spark, d, t) for t in COLUMNS}


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return replace_columns(df, {c: F.round(col(c), digits) for c in cols})


def day(c: str) -> Column:
    """A date or time as ISO text, the same in every engine."""
    return F.date_format(col(c), "yyyy-MM-dd").alias(c)


# Masked inputs: the same rule in Spark and in SQL, over whole tables.

def events_masked(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    i = F.col("event_id")
    return e.select(
        "event_id", "ts", "user_id",
        F.when(i % 11 != 0, F.col("event_type")).alias("event_type"),
        F.when(i % 7 != 0, F.col("value")).alias("value"), "props",
        F.when(i % 2 == 0, F.col("value")).alias("sparse"),
        F.lit(None).cast("double").alias("empty"),
        F.when(i % 5 >= 2, F.col("value")).alias("at_threshold"))


EVENTS_MASKED = """em AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 11 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 7 <> 0 THEN value END AS value, props,
         CASE WHEN event_id % 2 = 0 THEN value END AS sparse,
         CAST(NULL AS DOUBLE) AS empty,
         CASE WHEN event_id % 5 >= 2 THEN value END AS at_threshold
  FROM events)"""


def part_masked(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        "p_partkey", F.when(k % 9 != 0, F.col("p_size").cast("double")).alias("p_size"),
        F.when(k % 10 != 3, F.col("p_retailprice")).alias("p_retailprice"))


PART_MASKED = """pm AS (
  SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS DOUBLE) END AS p_size,
         CASE WHEN p_partkey % 10 <> 3 THEN p_retailprice END AS p_retailprice
  FROM part)"""


def lineitem_masked(spark: SparkSession, d: str) -> DataFrame:
    at = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    return replace_columns(table(spark, d, "lineitem"), {"l_tax": F.when(at != 0, F.col("l_tax"))})


LINEITEM_MASKED = """lm AS (
  SELECT * REPLACE (CASE WHEN (l_orderkey + l_linenumber) % 8 <> 0 THEN l_tax END AS l_tax)
  FROM lineitem)"""


def uniform_sql(salt: str, *keys: str) -> str:
    """The keyed uniform draw in SQL."""
    text = "||'|'||".join([f"'{salt}'", *[
        f"coalesce(length(CAST({k} AS VARCHAR))||':'||CAST({k} AS VARCHAR), '-')" for k in keys]])
    return f"((CAST('0x' || substr(sha256({text}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"
