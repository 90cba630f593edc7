"""Nearest rows over incomplete columns: a tree of cells with boxes, searched from the top for all rows at once.

Equal rows are one point. Points of one pattern of present columns are cut into cells by splits of their columns, a
bit each, so a cell's number is a path and its leading bits name the nodes above it. A node has a box and a count. A level
of the search is one join of (query, node) with the nodes below and one minimum per query: a node
with enough points in a box that is nowhere farther than ``reach`` bounds the answer, and nodes whose box is nowhere nearer are
left out. The bounds hold for the columns that both sides have, so any pattern can ask any other.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage

#: Points of a cell, about.
CELL_ROWS = 64
#: Splits from one level of the search to the next.
_BITS = 6
#: Pieces of the distribution of a column within which splits are even.
_PIECES = 64
#: Bounds and distances are rounded differently.
_SLACK = 1 + 1e-9


def _share(x: Column, edges: list[float]) -> Column:
    """Which share of a column's values lies below ``x``, about: linear between the edges."""
    n, table = len(edges) - 1, F.lit(edges)
    below = F.greatest(F.least(F.size(F.filter(table, lambda e: e <= x)), F.lit(n)), F.lit(1)) - 1
    lo, hi = F.get(table, below), F.get(table, below + 1)
    part = F.when(hi > lo, F.least(F.greatest((x - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    return (below + part) / F.lit(float(n))


class CellTree:
    """Points with the columns ``names`` (double, null where absent) and ``key``, at most ``k`` smallest keys per point."""

    def __init__(self, rows: DataFrame, names: list[str], k: int, cell_rows: int = CELL_ROWS):
        self.names, self.k = names, k
        present = [F.col(n).isNotNull() for n in names]
        # Only the k smallest keys of equal rows can be among the k nearest; a task passes on no more.
        order = Window.partitionBy(*names).orderBy("key")
        few = rows.where(reduce(lambda a, b: a | b, present)).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
        points = cut_lineage(few.groupBy(*names).agg(F.sort_array(F.collect_list("key")).alias("keys")))
        cuts = [i / _PIECES for i in range(_PIECES + 1)]
        told = points.agg(F.count(F.lit(1)).alias("n"), *[
            F.percentile_approx(n, cuts, 1_000).alias(n) for n in names]).first()
        splits = self._splits({n: told[n] for n in names if told[n]}, math.ceil(math.log2(max(1, told["n"]) / cell_rows)))
        self.bits = len(splits)
        placed = points.select("*", *[
            F.when(F.col(n).isNotNull(), _share(F.col(n), told[n])).alias(f"_at_{n}") for n in dict.fromkeys(splits)])
        self.points = cut_lineage(placed.select(
            "keys", *names, F.concat(*[F.when(p, "1").otherwise("0") for p in present]).alias("pattern"),
            self._path(splits).alias("path")))
        boxes = [f(n).alias(f"{e}_{n}") for n in names for e, f in (("lo", F.min), ("hi", F.max))]
        cells = cut_lineage(self.points.groupBy("pattern", "path").agg(
            F.sum(F.size("keys")).alias("n"), *boxes))
        #: Nodes by level, from one per pattern down to the cells.
        self.levels: list[tuple[int, DataFrame]] = []
        for depth in [*range(0, self.bits, _BITS), self.bits]:
            path = F.shiftright("path", self.bits - depth)
            self.levels.append((depth, cells.groupBy("pattern", path.alias("path")).agg(F.sum("n").alias("n"), *[
                f(f"{e}_{n}").alias(f"{e}_{n}") for n in names for e, f in (("lo", F.min), ("hi", F.max))])))

    @staticmethod
    def _splits(edges: dict[str, list[float]], bits: int) -> list[str]:
        """Which column each bit splits: the widest at that point, as distances are not scaled."""
        low, high = _PIECES // 16, _PIECES - _PIECES // 16
        width = {n: e[high] - e[low] or e[-1] - e[0] for n, e in edges.items()}
        out: list[str] = []
        for _ in range(max(0, bits)):
            widest = max(width, key=lambda n: width[n], default=None)
            if widest is None or not width[widest]:
                break
            out.append(widest)
            width[widest] /= 2
        return out

    @staticmethod
    def _path(splits: list[str]) -> Column:
        """The bits of a point's cell, from the shares ``_at_<column>`` of its values; an absent value's bits are 0."""
        path, seen = F.lit(0).cast("long"), dict.fromkeys(splits, 0)
        for n in splits:
            seen[n] += 1
            bit = F.floor(F.least(F.col(f"_at_{n}"), F.lit(1 - 1e-12)) * F.lit(float(1 << seen[n]))) % 2
            path = F.shiftleft(path, 1) + F.coalesce(bit, F.lit(0).cast("long"))
        return path

    def _sums(self, gap) -> tuple[Column, Column]:
        """(scaled sum of squared gaps, shared columns) over the columns that both sides have."""
        parts = [gap(n) for n in self.names]
        shared = reduce(add, [F.when(p.isNotNull(), 1).otherwise(0) for p in parts])
        total = reduce(add, [F.coalesce(p * p, F.lit(0.0)) for p in parts])
        return total * (F.lit(float(len(self.names))) / shared), shared

    def candidates(self, queries: DataFrame) -> DataFrame:
        """(r, j, columns of the query, pattern, path): the cells that may hold one of the ``k`` nearest points with column ``j``.

        ``queries`` have an id ``r``, the number ``j`` of the wanted column, and the columns.
        """
        lower, shared = self._sums(lambda n: F.greatest(
            F.col(f"lo_{n}") - F.col(n), F.col(n) - F.col(f"hi_{n}"), F.when(F.col(n).isNotNull() & F.col(f"lo_{n}").isNotNull(), 0.0)))
        upper, _ = self._sums(lambda n: F.when(F.col(n).isNotNull() & F.col(f"lo_{n}").isNotNull(), F.greatest(
            F.abs(F.col(n) - F.col(f"lo_{n}")), F.abs(F.col(n) - F.col(f"hi_{n}")))))
        one = Window.partitionBy("r", "j")
        found, last = None, 0
        for depth, nodes in self.levels:
            if found is None:
                having = F.array_compact(F.array(*[
                    F.when(F.col(f"lo_{n}").isNotNull(), F.lit(i)) for i, n in enumerate(self.names)]))
                joined = queries.withColumn("reach", F.lit(float("inf"))).join(
                    nodes.withColumn("j", F.explode(having)), "j")
            else:
                above = nodes.withColumn("_above", F.shiftright("path", depth - last))
                joined = found.withColumnRenamed("path", "_above").join(above, ["pattern", "_above"])
            bounds = joined.where(shared > 0).select(
                "r", "j", *self.names, "pattern", "path", "reach", lower.alias("lower"),
                F.when(F.col("n") >= self.k, upper).alias("upper"))
            reach = F.least("reach", F.coalesce(F.min("upper").over(one), F.lit(float("inf")))) * F.lit(_SLACK)
            found = bounds.withColumn("reach", reach).where(F.col("lower") <= F.col("reach")).drop("lower", "upper")
            last = depth
        return found

    def pairs(self, queries: DataFrame) -> DataFrame:
        """(r, j, far, keys, value) for every point of the candidate cells."""
        points = self.points.select("pattern", "path", "keys", *[F.col(n).alias(f"o_{n}") for n in self.names])
        far, _ = self._sums(lambda n: F.col(n) - F.col(f"o_{n}"))
        value = F.get(F.array(*[F.col(f"o_{n}") for n in self.names]), F.col("j"))
        return self.candidates(queries).join(points, ["pattern", "path"]).select(
            "r", "j", far.alias("far"), "keys", value.alias("value"))

    def nearest_means(self, queries: DataFrame) -> DataFrame:
        """(r, j, mean): the mean of column ``j`` over the ``k`` nearest rows, equal distances in key order."""
        order = Window.partitionBy("r", "j").orderBy("far", "key")
        each = self.pairs(queries).select("r", "j", "far", "value", F.explode("keys").alias("key"))
        best = each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= self.k)
        return best.groupBy("r", "j").agg(F.avg("value").alias("mean"))
