"""Helpers shared by the operators: words of Arrow batches, keyed order, running sums."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlark.functions.types import col

#: A word is a run of characters other than these six.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same as a class for Java's and DuckDB's patterns.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
#: Bytes of text that a Python task works on at once (one longer text is worked on alone).
SLICE_BYTES = 2 << 20
#: Rows that a window of one bucket holds, about.
ROWS_PER_BUCKET = 10_000

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Words:
    """The words of some texts: ``vocabulary`` (bytes), ``ids`` into it, ``offsets`` by text.

    ``fold`` turns A-Z into a-z first.
    """

    def __init__(self, texts: pa.Array, fold: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("")
        # A slice shares its parent's buffers; concat_arrays copies just its part.
        texts = pa.concat_arrays([texts])
        first, *_ = bounds = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset: texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[first: bounds[-1]] if data else np.zeros(0, np.uint8)
        if fold:
            raw = raw + (((raw >= 65) & (raw <= 90)) << 5).astype(np.uint8)
        bounds = bounds - first
        inside = ~_IS_SPACE[raw]
        before = np.empty_like(inside)
        if len(inside):
            before[0] = False
            before[1:] = inside[:-1]
            before[bounds[(bounds > 0) & (bounds < len(raw))]] = False
        starts = np.flatnonzero(inside & ~before)
        self.offsets = np.searchsorted(starts, bounds)
        kept = np.concatenate([[0], np.cumsum(inside)])
        ends = np.append(kept[starts[1:]], kept[-1]) if len(starts) else np.zeros(0, np.int64)
        cuts = np.concatenate([[0], ends]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(raw[inside])])
        coded = words.dictionary_encode()
        self.ids = coded.indices.to_numpy()
        self.vocabulary = coded.dictionary.to_pylist()

    def texts(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def trim() -> None:
    """Give freed memory back. A Python worker stays for the next task, and a task can have several workers."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release is not None:
        release(0)


def trimmed(f: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of one group that gives its memory back."""
    def run(table: pa.Table) -> pa.Table:
        out = f(table)
        trim()
        return out

    return run


def trimmed_stream(f: Callable) -> Callable:
    """A function of batches that gives its memory back at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        trim()

    return run


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indices first[i], first[i]+1, ... (n[i] of them) for all i, one after the other."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - n), n)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def keyed_order(seed: str, *parts: Column) -> Column:
    """A uniform 60-bit key that depends on the seed and the parts alone."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def keyed_order_sql(seed: str, *parts: str) -> str:
    text = "||'|'||".join([f"'{seed}'", *[f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts]])
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"


def running_sums(
    df: DataFrame, group: list[str], key: str, ties: list[str], sums: dict[str, Column],
    totals: dict[str, str], rows: int, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add sums over all rows of the group before the current one, in order of ``key``.

    ``key`` is a uniform 60-bit number, so its leading bits cut every group into buckets of
    about ``rows_per_bucket`` rows, however large the group. Bucket totals, folded before the
    shuffle, become offsets; a window runs inside a bucket only. ``sums``: new column -> what to
    add up. ``totals``: new column -> which of the sums to give for the whole group.
    """
    bits = max(0, math.ceil(math.log2(max(1, rows) / rows_per_bucket)))
    at = [*group, "_bucket"]
    cut = df.withColumn("_bucket", F.shiftright(col(key), 60 - bits) if bits else F.lit(0).cast("long"))
    folded = cut.groupBy(*at).agg(*[F.sum(c).alias(f"_all_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = folded.select(
        *[col(g).alias(f"_at_{i}") for i, g in enumerate(at)],
        *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_all_{n}").over(whole).alias(new) for new, n in totals.items()])
    inside = Window.partitionBy(*at).orderBy(key, *ties)
    until = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("*", *[F.coalesce(F.sum(c).over(until), F.lit(0)).alias(f"_in_{n}")
                              for n, c in sums.items()])
    same = [col(g).eqNullSafe(F.col(f"_at_{i}")) for i, g in enumerate(at)]
    joined = local.join(offsets, same)
    return joined.select(*[col(c) for c in df.columns],
                         *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums],
                         *totals)
