"""Second moments of many columns from one scan: a block per task, blocks merged in a tree.

A block holds, for every pair of columns, the number of rows that have both, the means over these rows and the sums of
centred products, so that blocks can be merged in any order without loss of digits. What comes back has
as many numbers as there are pairs of columns, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class PairMoments(NamedTuple):
    """``n[i, j]`` rows have columns i and j; ``mean[i, j]`` is that of i over them, ``var`` and ``cov`` sums of centred products."""

    n: np.ndarray
    mean: np.ndarray
    var: np.ndarray
    cov: np.ndarray

    def correlation(self) -> np.ndarray:
        """Pearson's r of every pair; NaN where there are no two rows or no spread."""
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.cov / np.sqrt(self.var * self.var.T)
        return np.where((self.n > 1) & (self.var > 0) & (self.var.T > 0), np.clip(r, -1.0, 1.0), np.nan)


def _empty(m: int) -> PairMoments:
    return PairMoments(*(np.zeros((m, m)) for _ in range(4)))


def _of_rows(x: np.ndarray) -> PairMoments:
    """The block of some rows; NaN is an absent value."""
    there = (~np.isnan(x)).astype(float)
    seen = there.sum(axis=0)
    shift = np.where(seen > 0, np.nansum(x, axis=0) / np.maximum(seen, 1), 0.0)
    y = np.where(there > 0, x - shift, 0.0)
    n = there.T @ there
    total = y.T @ there
    mean = total / np.maximum(n, 1)
    var = np.maximum((y * y).T @ there - total * mean, 0.0)
    return PairMoments(n, np.where(n > 0, mean + shift[:, None], 0.0), var, y.T @ y - total * mean.T)


def _merged(a: PairMoments, b: PairMoments) -> PairMoments:
    n = a.n + b.n
    share = np.where(n > 0, b.n / np.maximum(n, 1), 0.0)
    gap = np.where((a.n > 0) & (b.n > 0), b.mean - a.mean, 0.0)
    weight = a.n * share
    mean = np.where(a.n > 0, a.mean + gap * share, b.mean)
    return PairMoments(n, mean, a.var + b.var + gap * gap * weight, a.cov + b.cov + gap * gap.T * weight)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Columns of doubles as one matrix, null as NaN."""
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)


def _tree(df: DataFrame, schema: str, merge: Callable) -> DataFrame:
    """One row for each row that one merging task would give of all of ``df``'s.

    Adaptive execution chooses how many tasks the middle level has, by the blocks' bytes.
    """
    names = df.columns
    middle = df.withColumn("_task", F.spark_partition_id()).repartition("_task").select(*names)
    return middle.mapInArrow(merge, schema).coalesce(1).mapInArrow(merge, schema)


def _doubles(c: Column) -> Column:
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def pair_moments(df: DataFrame, columns: list[Column]) -> PairMoments:
    """Moments of all pairs over the rows where both columns have values; NaN is read as null."""
    m = len(columns)
    schema = "block array<double>"

    def row(block: PairMoments) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.stack(block).ravel()], pa.list_(pa.float64()))], names=["block"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _empty(m)
        for batch in batches:
            block = _merged(block, _of_rows(_matrix(batch)))
        yield row(block)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _empty(m)
        for batch in batches:
            for i in range(len(batch)):
                flat = batch.column(0).slice(i, 1).flatten().to_numpy()
                block = _merged(block, PairMoments(*flat.reshape(4, m, m)))
        yield row(block)

    narrow = df.select([_doubles(c).alias(f"c{i}") for i, c in enumerate(columns)])
    found = _tree(narrow.mapInArrow(gather, schema), schema, merge).collect()
    blocks = [PairMoments(*np.array(r["block"]).reshape(4, m, m)) for r in found]
    out = _empty(m)
    for b in blocks:
        out = _merged(out, b)
    return out


def pattern_products(df: DataFrame, columns: list[Column], pattern: Column) -> dict[int, np.ndarray]:
    """Per value of ``pattern``: the sums of products of (1, columns) over its rows, null as 0.

    Columns should be centred and scaled. The patterns are held together by one task: count them first.
    """
    side = len(columns) + 1
    schema = "pattern long, block array<double>"

    def rows(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(list(blocks), pa.int64()),
            pa.array([b.ravel() for b in blocks.values()], pa.list_(pa.float64()))], names=["pattern", "block"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.nan_to_num(_matrix(batch.select(batch.schema.names[1:])))
            x = np.column_stack([np.ones(len(x)), x])
            kinds, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            for i, kind in enumerate(kinds.tolist()):
                part = x[at == i]
                blocks[kind] = blocks.get(kind, 0.0) + part.T @ part
        yield rows(blocks)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, kind in enumerate(batch.column(0).to_pylist()):
                blocks[kind] = blocks.get(kind, 0.0) + batch.column(1).slice(i, 1).flatten().to_numpy()
        yield rows(blocks)

    narrow = df.select(pattern.cast("long").alias("pattern"), *[_doubles(c).alias(f"c{i}") for i, c in enumerate(columns)])
    found = _tree(narrow.mapInArrow(gather, schema), schema, merge).collect()
    return {r["pattern"]: np.array(r["block"]).reshape(side, side) for r in found}
