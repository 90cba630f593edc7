"""Information of a number about a label by nearest neighbours in one dimension, as joins and bounded windows.

For every value the distance to its k-th neighbour with the same label, and how many rows of any label lie within
that distance. Equal values are one point with a count; a label's points are numbered in order and cut into chunks
whose borders go to both sides, so a window holds a chunk, however many rows a label has.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.ranking import ROWS_PER_BUCKET, running_totals
from medlark.functions.storage import cut_lineage
from medlark.functions.types import col

#: Fixed value: neighbours of the estimate.
NEIGHBOURS = 3
#: Distances that differ by less, measured by the numbers they come from, are equal.
ROUNDING = 1e-12


def digamma(n: Column) -> Column:
    """For whole numbers from 1: six steps up, then the asymptotic series; right to 1e-11."""
    x = n.cast("double")
    up = x + F.lit(6.0)
    q = F.lit(1.0) / (up * up)
    series = F.log(up) - F.lit(0.5) / up - q * (F.lit(1 / 12) - q * (F.lit(1 / 120) - q * (F.lit(1 / 252) - q * F.lit(1 / 240))))
    return series - reduce(add, [F.lit(1.0) / (x + F.lit(float(j))) for j in range(6)])


def _neighbour_distance(points: DataFrame, k: int, chunk_rows: int) -> DataFrame:
    """Points (g, i, y, x, n, of) with ``far``: the distance to the k-th other row of their group, ``k`` at most the others there are.

    ``at`` numbers the points of a group; a chunk gets the ``k`` points before and after it.
    """
    chunk = F.floor(F.col("at") / chunk_rows)
    homes = F.array_distinct(F.array(
        chunk, F.greatest(F.floor((F.col("at") - k) / chunk_rows), F.lit(0).cast("long")), F.floor((F.col("at") + k) / chunk_rows)))
    dealt = points.withColumn("home", chunk).withColumn("chunk", F.explode(homes))
    order = Window.partitionBy("g", "chunk").orderBy("at")
    # The point itself offers its other rows at no distance; each neighbour all of its rows.
    near = [F.struct(F.lit(0.0).alias("d"), (F.col("n") - 1).alias("n"))]
    for step in range(1, k + 1):
        for f in (F.lag, F.lead):
            near.append(F.when(f("x", step).over(order).isNotNull(), F.struct(
                F.abs(F.col("x") - f("x", step).over(order)).alias("d"), f("n", step).over(order).alias("n"))))
    listed = dealt.withColumn("near", F.array_sort(F.array_compact(F.array(*near)))).where(F.col("home") == F.col("chunk"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d"))
    reached = F.aggregate("near", start, lambda a, e: F.when(a["n"] >= F.col("k"), a).otherwise(
        F.struct((a["n"] + e["n"]).alias("n"), e["d"].alias("d"))))
    return listed.select("i", "y", "x", "n", "of", "k", reached["d"].alias("far"))


def neighbour_information(
    df: DataFrame, label: str, cols: list[str], k: int = NEIGHBOURS, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(feature, mi) in nats between the label and each column; a null value is 0, rows without a label are left out.

    digamma(rows) + mean digamma(k) - mean digamma(rows of the label) - mean digamma(rows nearer than the k-th neighbour of
    the label, the row itself included); never below 0. Labels with one row are left out; a label with fewer
    other rows than ``k`` uses those. Values are not scaled and no noise is added: rows whose k-th
    neighbour has the same value count the rows with that value. 0 where no label has two rows.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.coalesce(F.nanvl(col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("x"))
                      for i, c in enumerate(cols)])
    long = df.where(col(label).isNotNull()).select(col(label).cast("string").alias("y"), F.inline(cells))
    counted = long.groupBy("i", "y", (F.col("x") + F.lit(0.0)).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    stored = cut_lineage(counted)
    sizes = stored.groupBy("i", "y").agg(F.sum("n").alias("of"))
    points = cut_lineage(stored.join(sizes, ["i", "y"]).where(F.col("of") > 1).select(
        F.concat_ws("|", "i", "y").alias("g"), "i", "y", "x", "n", "of", F.least(F.lit(k), F.col("of") - 1).alias("k"),
        F.lit(1).cast("long").alias("one")))
    rows = points.count()
    numbered = running_totals(points, "x", {"at": "one"}, rows, rows_per_bucket, "g")
    # Rows as far as the neighbour, but for rounding, are not nearer than it.
    width = F.col("far") - F.lit(ROUNDING) * (F.abs("x") + F.col("far"))
    reach = cut_lineage(_neighbour_distance(numbered, k, rows_per_bucket).withColumn("far", F.greatest(width, F.lit(0.0))))

    # Rows nearer than ``far``: those below the upper border less those up to the lower one.
    border = F.when(F.col("far") > 0, F.array(F.col("x") - F.col("far"), F.col("x") + F.col("far"))).otherwise(F.array("x"))
    asked = reach.select("i", F.explode(border).alias("x")).distinct().withColumn("n", F.lit(0).cast("long"))
    places = cut_lineage(points.select("i", "x", "n").unionByName(asked).groupBy("i", "x").agg(F.sum("n").alias("n")))
    upto = running_totals(places, "x", {"upto": "n"}, places.count(), rows_per_bucket, "i")
    low, high = (upto.select("i", F.col("x").alias(f"{e}_x"), F.col("n").alias(f"{e}_n"), F.col("upto").alias(f"{e}_upto"))
                 for e in ("low", "high"))
    bordered = reach.withColumns({"low_x": F.col("x") - F.col("far"), "high_x": F.col("x") + F.col("far")})
    near = bordered.join(low, ["i", "low_x"]).join(high, ["i", "high_x"])
    within = F.when(F.col("far") > 0, F.col("high_upto") - F.col("high_n") - F.col("low_upto")).otherwise(F.col("high_n"))
    n = F.col("n")
    per = near.groupBy("i").agg(
        F.sum("n").alias("rows"), F.sum(n * (digamma(F.col("k")) - digamma(F.col("of")) - digamma(within))).alias("sum"))
    every = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, feature string")
    mi = digamma(F.col("rows")) + F.col("sum") / F.col("rows")
    return every.join(per, "i", "left").select("feature", F.coalesce(F.greatest(mi, F.lit(0.0)), F.lit(0.0)).alias("mi"))


def digamma_sql(n: str) -> str:
    """The same in SQL."""
    up = f"(({n}) + 6.0::DOUBLE)"
    q = f"(1.0::DOUBLE / ({up} * {up}))"
    steps = " - ".join(f"1.0::DOUBLE / (({n}) + {j}.0::DOUBLE)" for j in range(6))
    return (f"(ln({up}) - 0.5::DOUBLE / {up} - {q} * ({1 / 12!r}::DOUBLE - {q} * ({1 / 120!r}::DOUBLE - {q} * ({1 / 252!r}::DOUBLE "
            f"- {q} * {1 / 240!r}::DOUBLE))) - {steps})")

