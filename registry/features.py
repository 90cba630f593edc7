from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.information import digamma_sql
from medlark.functions.moments import pair_moments
from medlark.operators import clean, features
from medlark.plans import fusion
from registry.base import query, rounded, table

# By falling variance at every scale of the tables.
WIDE = ["l_extendedprice", "net", "l_quantity", "l_linenumber", "l_discount", "l_tax"]
ITEMS_SQL = """items AS (
  SELECT l_orderkey, l_partkey, l_quantity, l_tax, l_linenumber, l_discount, l_extendedprice,
         l_extendedprice * (1 - l_discount) AS net FROM lineitem)"""


def items(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_tax", "l_linenumber", "l_discount",
        "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


_BASE = ", ".join(["l_orderkey", "l_partkey", "l_quantity", "l_tax", "l_linenumber", "l_discount",
                   "l_extendedprice", "net"])
_PAIRS = list(combinations(WIDE, 2))
_PRODUCTS = ", ".join(f"{a} * {b} AS {a}_x_{b}" for a, b in _PAIRS)
_POLY = ", ".join(f"{a} * {b} AS poly_{a}_x_{b}" for a, b in _PAIRS)


@query("log_skewed", """
SELECT event_id, user_id, value, round(ln(1 + value), 9) AS value_log FROM events""")
def log_skewed(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "value")
    return rounded(features.log_skewed(e), 9, "value_log")


@query("cross_named", """
SELECT l_orderkey, l_quantity, l_tax, l_quantity * l_tax AS l_quantity_x_l_tax FROM lineitem""")
def cross_named(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    return features.cross_named(t, ["quantity"], ["tax"])


@query("top_variance_products", f"WITH {ITEMS_SQL} SELECT {_BASE}, {_PRODUCTS} FROM items")
def top_variance_products(spark, d):
    return features.top_variance_products(items(spark, d), WIDE)


@query("poly_interactions", f"WITH {ITEMS_SQL} SELECT {_BASE}, {_POLY} FROM items")
def poly_interactions(spark, d):
    return features.poly_interactions(items(spark, d), WIDE)


@query("engineer_features", f"WITH {ITEMS_SQL} SELECT {_BASE}, {_PRODUCTS}, {_POLY} FROM items")
def engineer_features(spark, d):
    return features.engineer_features(items(spark, d), WIDE, ["quantity"], ["tax"])


@query("drop_low_variance", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem""")
def drop_low_variance(spark, d):
    t = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return features.drop_low_variance(t, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def text_features(spark, d) -> DataFrame:
    """Labelled documents with counts over their whole text."""
    docs = table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        (F.length("text") - F.length(F.regexp_replace("text", "[0-9]", ""))).cast("double")
        .alias("n_digits"),
        F.length("lang").cast("double").alias("n_lang"))
    return table(spark, d, "labels").join(docs, "doc_id")


TEXT_SQL = """tf AS (
  SELECT doc_id, quality, toxic, CAST(n_chars AS DOUBLE) AS n_chars,
         CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
         CAST(length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS DOUBLE) AS n_digits,
         CAST(length(lang) AS DOUBLE) AS n_lang
  FROM labels JOIN documents USING (doc_id))"""
TEXT = ["n_chars", "n_words", "n_digits", "n_lang"]


def _information(c: str) -> str:
    cuts = " + ".join(
        f"CASE WHEN {c} > q[{i}] AND (q[{i}] <> q[{max(1, i - 1)}] OR {i} = 1) THEN 1 ELSE 0 END"
        for i in range(1, 10))
    probs = ", ".join(f"{i / 10!r}" for i in range(1, 10))
    return f"""
SELECT '{c}' AS feature, round(greatest(sum(n * 1.0 / t * ln(n * 1.0 * t / (nx * ny))), 0), 9) + 0.0
       AS mi FROM (
  SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY b) AS nx,
         sum(n) OVER (PARTITION BY y) AS ny FROM (
    SELECT {cuts} AS b, quality AS y, count(*) AS n
    FROM tf, (SELECT quantile_cont({c}, [{probs}]) AS q FROM tf) GROUP BY 1, 2))"""


MI_SQL = f"WITH {TEXT_SQL} " + " UNION ALL ".join(map(_information, TEXT))


@query("mutual_information", MI_SQL)
def mutual_information(spark, d):
    return rounded(features.mutual_information(text_features(spark, d), "quality", TEXT), 9, "mi")


def _neighbours_sql(c: str) -> str:
    """Every row against every other one, value by value."""
    return f"""
SELECT '{c}' AS feature, round(greatest(0, {digamma_sql('count(*)')} + avg({digamma_sql('k')} - {digamma_sql('of_label')}
       - {digamma_sql('near')})), 9) AS mi FROM (
  SELECT a.doc_id, any_value(a.k) AS k, any_value(a.of_label) AS of_label,
         count(*) FILTER (WHERE CASE WHEN far = 0 THEN abs(b.x - a.x) <= 0 ELSE abs(b.x - a.x) < far END) AS near
  FROM (SELECT p.doc_id, any_value(p.x) AS x, any_value(p.k) AS k, any_value(p.of_label) AS of_label,
               list_sort(list(abs(o.x - p.x)))[any_value(p.k)] AS kth,
               greatest(kth - 1e-12::DOUBLE * (abs(any_value(p.x)) + kth), 0) AS far
        FROM p_{c} p JOIN p_{c} o ON o.y = p.y AND o.doc_id <> p.doc_id GROUP BY p.doc_id) a
  CROSS JOIN p_{c} b GROUP BY a.doc_id)"""


def _points_sql(c: str) -> str:
    return f"""p_{c} AS (SELECT doc_id, quality AS y, CAST({c} AS DOUBLE) AS x, count(*) OVER (PARTITION BY quality) AS of_label,
  least(3, count(*) OVER (PARTITION BY quality) - 1) AS k FROM tf)"""


NEAR = ["n_chars", "n_digits"]


@query("neighbour_information", f"WITH {TEXT_SQL}, {', '.join(map(_points_sql, NEAR))} "
                                + " UNION ALL ".join(f"SELECT * FROM ({_neighbours_sql(c)})" for c in NEAR))
def neighbour_information(spark, d):
    return rounded(features.neighbour_information(text_features(spark, d), "quality", NEAR), 9, "mi")


@query("select_by_mi", f"""
WITH mi AS ({MI_SQL}), top AS (SELECT feature FROM mi ORDER BY mi DESC, feature LIMIT 2),
{TEXT_SQL}
SELECT doc_id, quality, feature, value
FROM (UNPIVOT (SELECT doc_id, quality, n_chars, n_words, n_digits, n_lang FROM tf)
      ON n_chars, n_words, n_digits, n_lang INTO NAME feature VALUE value)
WHERE feature IN (SELECT feature FROM top)""")
def select_by_mi(spark, d):
    kept = features.select_by_mi(text_features(spark, d).drop("toxic"), "quality", TEXT, k=2)
    names = [c for c in kept.columns if c in TEXT]
    return kept.unpivot(["doc_id", "quality"], names, "feature", "value")


@query("select_by_variance", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem""")
def select_by_variance(spark, d):
    t = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return features.select_by_variance(
        t, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], k=2)


def vectors(spark, d) -> DataFrame:
    return features.unpack_vector(table(spark, d, "embeddings"), "embedding", 64, "e")


@query("pca", """
WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
z AS (SELECT vec_id, label, (x - avg(x) OVER (PARTITION BY i)) / stddev_pop(x) OVER (PARTITION BY i) AS z FROM e)
SELECT vec_id, label, round(sum(z * z), 4) AS squares FROM z GROUP BY 1, 2""")
def pca(spark, d):
    """All components: a row's sum of squares is that of the standardized row."""
    v = vectors(spark, d)
    done = features.pca(v, [c for c in v.columns if c.startswith("e")], 64, keep=["vec_id", "label"]).table
    parts = F.array(*[F.col(c) for c in done.columns if c.startswith("PC")])
    squares = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x * x)
    return done.select("vec_id", "label", F.round(squares, 4).alias("squares"))


@query("reduce_features")
def reduce_features(spark, d):
    return features.reduce_features(
        vectors(spark, d).drop("vec_id"), ["outcome", "label"], k=50, n=30).table


@query("reduce_features_squares", """
WITH x AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS outcome, l_quantity AS a, l_extendedprice AS b,
                  l_discount * 100 AS c, l_tax * 100 AS d FROM lineitem),
s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, avg(c) AS mc, stddev_pop(c) AS sc,
             avg(d) AS md, stddev_pop(d) AS sd FROM x)
SELECT outcome, 4 AS components, round(((a - ma) / sa) ** 2 + ((b - mb) / sb) ** 2 + ((c - mc) / sc) ** 2 + ((d - md) / sd) ** 2, 4)
       AS squares FROM x, s""")
def reduce_features_squares(spark, d):
    """The label is found and carried, the constant goes, and four components keep each row's length."""
    t = table(spark, d, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("outcome"), "l_quantity", "l_extendedprice",
        (F.col("l_discount") * 100).alias("discount"), (F.col("l_tax") * 100).alias("tax"), F.lit(7.0).alias("site"))
    done = features.reduce_features(t, ["label", "outcome"])
    parts = [c for c in done.table.columns if c != done.label]
    squares = F.aggregate(F.array(*parts), F.lit(0.0), lambda a, x: a + x * x)
    return done.table.select(F.col(done.label).alias("outcome"), F.lit(len(parts)).alias("components"), F.round(squares, 4).alias("squares"))


@query("fuse_tables")
def fuse_tables(spark, d):
    """Two tables of one domain stacked, engineered and projected, beside a domain of one table."""
    items = table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("amount"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("share"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
        .alias("outcome"))
    parts = table(spark, d, "part").select(
        F.col("p_size").cast("double").alias("amount"), F.col("p_retailprice").alias("price"),
        (F.col("p_size") / 50.0).alias("share"), F.lit(0).alias("outcome"))
    fused = fusion.fuse({"items": items, "parts": parts}, {"goods": ["items", "parts"]}, n=4)
    return fused["goods"].table


@query("encode_codes", """
SELECT o_orderkey, o_orderpriority, o_orderstatus,
       dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS priority_code,
       dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS status_code FROM orders""")
def encode_codes(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return clean.encode_codes(
        o, {"o_orderpriority": "priority_code", "o_orderstatus": "status_code"})


@query("pca_components", """
SELECT 30::BIGINT AS components, 1::BIGINT AS by_falling_variance, 1::BIGINT AS uncorrelated, 1::BIGINT AS explained_is_their_variance,
       count(*) AS n_rows FROM embeddings""")
def pca_components(spark, d):
    """What makes them principal components: order, no correlation, and the share of variance the model tells; 30 of 64."""
    names = [f"e{i}" for i in range(64)]
    done = features.pca(vectors(spark, d), names, keep=["vec_id"])
    parts = [c for c in done.table.columns if c.startswith("PC")]
    m = pair_moments(done.table, [F.col(c) for c in parts])
    own = np.diag(m.var) / m.n[0, 0]
    mixed = m.correlation() - np.eye(len(parts))
    row = (len(parts), int((np.diff(own) <= 1e-9).all()), int(np.abs(mixed).max() < 1e-6),
           int(np.allclose(own / len(names), done.explained, atol=1e-9)), int(m.n[0, 0]))
    return spark.createDataFrame([row], "components long, by_falling_variance long, uncorrelated long, "
                                        "explained_is_their_variance long, n_rows long")
