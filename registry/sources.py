from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import scratch_path
from medlark.plans.cleaning import clean_tables
from medlark.sources import readers, tree, writers
from registry.base import COLUMNS, all_tables, day, query, table

CUSTOMER = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
            "c_mktsegment string")


@query("read_delimited", "SELECT * FROM customer")
def read_delimited(spark, d):
    path = scratch_path(spark, "customer")
    writers.write_csv(table(spark, d, "customer"), path, sep=";")
    return readers.read_delimited(spark, path, schema=CUSTOMER)


@query("read_headerless", "SELECT * FROM nation")
def read_headerless(spark, d):
    path = scratch_path(spark, "nation")
    table(spark, d, "nation").write.csv(path)
    return readers.read_headerless(spark, path, COLUMNS["nation"],
                                   schema="a int, b string, c int")


@query("read_json_records", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events""")
def read_json_records(spark, d):
    path = scratch_path(spark, "events")
    nested = table(spark, d, "events").select(
        "event_id", F.from_json("props", "k bigint").alias("props"))
    nested.write.json(path)
    return readers.read_json_records(
        spark, path, schema="event_id bigint, props struct<k: bigint>", multiline=False)


@query("parse_json_column", """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events""")
def parse_json_column(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "props")
    return readers.parse_json_column(e, "props", "k bigint")


@query("read_parquet", "SELECT * FROM supplier")
def read_parquet(spark, d):
    return readers.read_parquet(spark, f"{d}/supplier.parquet")


@query("scan_tree", """
SELECT 'customer' AS folder, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer
UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier""")
def scan_tree(spark, d):
    root = scratch_path(spark, "tree")
    writers.write_parquet(
        table(spark, d, "customer").select(F.col("c_custkey").alias("key")), f"{root}/customer")
    writers.write_parquet(
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("key")), f"{root}/supplier")
    table(spark, d, "nation").write.json(f"{root}/notes")
    found = readers.scan_tree(spark, root, pattern="*.parquet", schema="key bigint")
    return found.groupBy(F.split("table_name", "__")[0].alias("folder")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("key").alias("key_sum"))


def mixed_files(spark, d) -> str:
    """The given tables as files of many kinds below one folder."""
    root = scratch_path(spark, "mixed")
    accents = F.concat("p_name", F.lit(" \u00e9\u00fc")).alias("p_name")
    writers.write_csv(table(spark, d, "customer"), f"{root}/people/customer", sep=";")
    table(spark, d, "supplier").write.csv(f"{root}/people/supplier", sep="\t", header=True)
    table(spark, d, "part").select("p_partkey", accents, "p_size").write.csv(f"{root}/goods/part", header=True, encoding="ISO-8859-1")
    table(spark, d, "orders").select("o_orderkey", "o_totalprice").write.json(f"{root}/orders")
    table(spark, d, "labels").write.parquet(f"{root}/labels")
    return root


_TREE_SQL = {
    "people__customer": ("customer", 5, "c_custkey", "length(c_name)"), "people__supplier": ("supplier", 4, "s_suppkey", "length(s_name)"),
    "goods__part": ("part", 3, "p_partkey", "length(p_name) + 3"), "orders": ("orders", 2, "o_orderkey", "0"),
    "labels": ("labels", 3, "doc_id", "0"),
}


@query("read_tree", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n, CAST({width} AS BIGINT) AS n_columns, CAST(sum({key}) AS BIGINT) AS key_sum, "
    f"CAST(sum({text}) AS BIGINT) AS chars FROM {t}" for name, (t, width, key, text) in _TREE_SQL.items()))
def read_tree(spark, d):
    """Files of five kinds found, grouped and read; what each table holds."""
    parts = []
    for name, df in tree.read_tree(spark, mixed_files(spark, d)).items():
        text = next((f.name for f in df.schema.fields if f.name in ("c_name", "s_name", "p_name")), None)
        key = next(c for c in df.columns if c in ("c_custkey", "s_suppkey", "p_partkey", "o_orderkey", "doc_id"))
        parts.append(df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.lit(len(df.columns)).cast("long").alias("n_columns"),
            F.sum(key).cast("long").alias("key_sum"), (F.sum(F.length(text)) if text else F.lit(0)).cast("long").alias("chars")))
    return reduce(DataFrame.unionByName, parts)


@query("clean_tree", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, 'ok' AS status, count(*) AS rows_after FROM {t}" for name, (t, *_) in _TREE_SQL.items()))
def clean_tree(spark, d):
    """The same files, read and cleaned; how each table ended."""
    out = scratch_path(spark, "cleaned")
    clean_tables(spark, tree.read_tree(spark, mixed_files(spark, d)), out, "run", impute="median")
    return readers.read_parquet(spark, f"{out}/audit").select("table_name", "status", "rows_after")


@query("read_json_wrapped", "SELECT n_nationkey, n_name FROM nation")
def read_json_wrapped(spark, d):
    """One object whose ``value`` holds the records."""
    path = scratch_path(spark, "wrapped")
    record = F.struct(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")
    table(spark, d, "nation").agg(F.to_json(F.struct(F.collect_list(record).alias("value"))).alias("value")).write.text(path)
    return readers.read_json_records(spark, path, schema="value array<struct<n_nationkey: int, n_name: string>>")


@query("read_json_list", "SELECT n_nationkey, n_name FROM nation")
def read_json_list(spark, d):
    """A list of records."""
    path = scratch_path(spark, "list")
    record = F.struct(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")
    table(spark, d, "nation").agg(F.to_json(F.collect_list(record)).alias("value")).write.text(path)
    return readers.read_json_records(spark, path, schema="n_nationkey int, n_name string")


@query("write_parquet", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def write_parquet(spark, d):
    path = scratch_path(spark, "orders")
    writers.write_parquet(table(spark, d, "orders"), path, partition_by=["o_orderstatus"])
    back = readers.read_parquet(spark, path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       day("o_orderdate"), "o_orderpriority")


@query("write_csv", "SELECT * FROM part")
def write_csv(spark, d):
    path = scratch_path(spark, "part")
    part = table(spark, d, "part")
    writers.write_csv(part, path)
    return readers.read_delimited(spark, path, schema=part.schema)


def audit_table(spark, d) -> DataFrame:
    """Audit rows of all given tables, written to the log and read back."""
    path = scratch_path(spark, "audit")
    rows = [
        dict(r, status="ok" if r["table_name"] != "region" else "skipped")
        for r in writers.audit_rows(all_tables(spark, d), "run")
    ]
    writers.append_audit(spark, path, rows[:7])
    writers.append_audit(spark, path, rows[7:])
    return spark.read.parquet(path)


def _audit_sql(name: str) -> str:
    cols = COLUMNS[name]
    missing = ", ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)
    return f"""
SELECT '{name}' AS table_name, '{"skipped" if name == "region" else "ok"}' AS status,
       count(*) AS rows_after, CAST({len(cols)} AS BIGINT) AS cols_after,
       round(greatest({missing}) / count(*), 4) AS missing_rate,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name})) AS duplicates
FROM {name}"""


AUDIT_SQL = " UNION ALL ".join(_audit_sql(t) for t in COLUMNS)


@query("append_audit", AUDIT_SQL)
def append_audit(spark, d):
    return audit_table(spark, d).select(
        "table_name", "status", "rows_after", "cols_after", "missing_rate", "duplicates")
