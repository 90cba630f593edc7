"""Equi-joins that hold when one key has a third of the rows.

Adaptive execution splits skewed partitions of inner, left, semi and anti joins, so those are left to
it. A full outer join is what it cannot split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col

# A side is broadcast only when its size was measured and is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than one task should have counts as hot.
HOT_ROWS = 1_000_000
_TRACKED = 10_000


def key_hash(on: list[str]) -> Column:
    return F.xxhash64(*[col(c) for c in on])


def hot_key_hashes(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> dict[int, int]:
    """Hash -> rough row count of keys with more than ``hot_rows`` rows.

    One scan of the key columns with a frequent-items sketch per task; keys
    are not shuffled. A hash collision puts some cold rows among the hot ones, no more.
    """
    h = df.select(key_hash(on).alias("h"))
    most = h.count() // hot_rows
    if most == 0:
        return {}
    top = h.agg(F.expr(f"approx_top_k(h, {min(most, _TRACKED // 2)}, {_TRACKED})").alias("top")).first()["top"]
    return {t["item"]: t["count"] for t in top if t["count"] > hot_rows}


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", lookup_bytes: int | None = None,
) -> DataFrame:
    """Join to a lookup table (inner, left, left_semi, left_anti); broadcast if its measured size is small."""
    small = lookup_bytes is not None and lookup_bytes <= BROADCAST_BYTES
    return facts.join(F.broadcast(lookup) if small else lookup, on, how)


def outer_join(left: DataFrame, right: DataFrame, on: list[str], hot: dict[int, int] | None = None,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer join, rows of hot keys apart.

    Cold keys meet in a plain full join. Of hot keys the matched rows come from an inner join, which
    can be split, and the others are told by the few hot keys that the other side has at all. Null keys
    match nothing.
    """
    if hot is None:
        hot = {**hot_key_hashes(left, on, hot_rows), **hot_key_hashes(right, on, hot_rows)}
    if not hot:
        return left.join(right, on, "full")
    is_hot = key_hash(on).isin(list(hot))
    a, b = left.where(is_hot), right.where(is_hot)
    parts = [
        left.where(~is_hot).join(right.where(~is_hot), on, "full"),
        a.join(b, on, "inner"),
        a.join(b.select(*on).distinct(), on, "left_anti"),
        b.join(a.select(*on).distinct(), on, "left_anti"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def hot_outer_chain(tables: list[DataFrame], on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer joins of all tables on one key.

    Hot keys are looked for in the tables themselves, never in a join result. With a hot key a step is
    stored before the next one reads it more than once, so the plan grows by the same for each table.
    """
    out, hot = tables[0], hot_key_hashes(tables[0], on, hot_rows)
    for i, t in enumerate(tables[1:]):
        hot = {**hot, **hot_key_hashes(t, on, hot_rows)}
        out = outer_join(cut_lineage(out) if hot and i else out, t, on, hot)
    return out
