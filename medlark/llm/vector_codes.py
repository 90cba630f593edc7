"""Short codes for vectors: one codebook per part, refined by ball k-means, all in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.storage import discard, scratch_path
from medlark.functions.types import col
from medlark.llm.common import trimmed_stream

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors that a task works on at once; the balls' radii are those within such a block.
BLOCK = 32_768
#: Neighbours up to which a ring of a ball is compared together.
RINGS = (8, 32, 96, ENTRIES)
#: Components up to the first limit have squared distances that doubles hold exactly, up to the second 64-bit numbers.
EXACT_DOUBLE = 1 << 20
MOST = 1 << 26


class Balls:
    """The entries of one part and what surrounds each: the others in order of distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.squares = (entries * entries).sum(axis=1)
        gaps = self.squares[:, None] + self.squares[None, :] - 2 * (entries @ entries.T)
        np.fill_diagonal(gaps, -1)
        order = np.argsort(gaps, axis=1, kind="stable")
        self.others = order[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.others, axis=1)

    def _nearest_of(self, x: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of some entries, given in ascending order, so that the lowest of equal ones is taken."""
        far = self.squares[among] - 2 * (x @ self.entries[among].T)
        best = far.argmin(axis=1)
        return among[best], far[np.arange(len(x)), best] + (x * x).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance for every row, all entries compared."""
        return self._nearest_of(x, np.arange(len(self.entries)))

    def renewed(self, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`nearest`, from the entries that the rows had before.

        An entry j can be as near to a row as its own entry i only if the two are at most twice the
        row's distance to i apart. So a ball has as neighbours the entries within twice its radius; rows
        whose own distance reaches none are its stable core and keep their entry without a comparison; the others are in
        rings by how many neighbours they reach, and are compared with these alone.
        """
        gap = x - self.entries[code]
        own = (gap * gap).sum(axis=1)
        codes, far = code.copy(), own.copy()
        by_entry = np.argsort(code, kind="stable")
        edges = np.searchsorted(code[by_entry], np.arange(len(self.entries) + 1))
        for i in np.flatnonzero(np.diff(edges)):
            ball = by_entry[edges[i]: edges[i + 1]]
            reach = 4 * own[ball]
            neighbours = int(np.searchsorted(self.gaps[i], reach.max(), side="right"))
            ring = np.searchsorted(self.gaps[i][:neighbours], reach, side="right")
            inner = 0
            for outer in RINGS:
                at = ball[(ring > inner) & (ring <= outer)]
                if len(at):
                    among = np.sort(np.append(self.others[i, :min(outer, neighbours)], i))
                    codes[at], far[at] = self._nearest_of(x[at], among)
                inner = outer
        return codes, far


def _rows(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """The lists of a column, all equally long, as one matrix."""
    lists = batch.column(name)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v) of vectors without null or non-finite components, as whole numbers rounded down."""
    v = F.col("v")
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    narrow = vectors.select(col(id_col).alias("vec_id"), col(label_col).alias("label"),
                            col(vector_col).cast("array<double>").alias("v"))
    return narrow.where(v.isNotNull() & (F.size(v) > 0) & ~broken).withColumn(
        "v", F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))))


def first_entries(kept: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest ids; equal ids in order of their components, null ids last."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    return np.array([r["v"] for r in rows])


def encode(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """One row per kept vector: its code, its error, the error of its label, the codebooks' digest.

    A pass per round reads the stored vectors with the entries they had and stores them with those they have now;
    next to them it stores, per task, what parts that changed entry add to and take from the sums. These are added up, and the
    codebooks, ``parts`` times ``entries`` rows, go to the driver and into the next pass. The table before is removed.

    Vectors that are null, empty, or hold a null or non-finite component are dropped. Null ids are kept, as the last. Repeated rows
    are vectors like others. With fewer vectors than ``entries`` there are as many entries. Null labels are one label.
    Vectors of different lengths, a length that ``parts`` does not divide, and components beyond 2^26 raise ValueError.
    Other columns are ignored. An empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number must fit a byte")
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, id_col, vector_col, label_col, scale)
    ids = {f.name: f.dataType for f in kept.schema.fields}
    told = kept.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("shortest"), F.max(F.size("v")).alias("longest"),
        F.max(F.greatest(F.abs(F.array_min("v")), F.abs(F.array_max("v")))).alias("most")).first()
    if not told["n"]:
        return kept.select("vec_id", F.lit("").alias("code"), *[
            F.lit(0).cast("long").alias(c) for c in ("error", "label_error")], F.lit("").alias("codebooks_sha256"))
    if told["shortest"] != told["longest"] or told["longest"] % parts:
        raise ValueError(f"vectors have {told['shortest']} to {told['longest']} components, in {parts} parts")
    if told["most"] > MOST:
        raise ValueError(f"components reach {told['most']}, more than {MOST}")
    kind = np.float64 if told["most"] <= EXACT_DOUBLE else np.int64
    books = first_entries(kept, entries).reshape(-1, parts, told["longest"] // parts).swapaxes(0, 1).copy()
    sums = np.zeros(books.shape, np.int64)
    counts = np.zeros(books.shape[:2], np.int64)

    row = T.StructType([
        T.StructField("vec_id", ids["vec_id"]), T.StructField("label", ids["label"]), T.StructField("v", T.ArrayType(T.IntegerType())),
        T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("moved", T.ArrayType(T.LongType()))])
    state, path, last = kept.withColumn("v", F.col("v").cast("array<int>")).withColumn("code", F.lit(None).cast("binary")), None, None
    for step in range(rounds + 1):
        assign = _pass(books, kind)
        path, last = scratch_path(spark, "vectors"), path
        state.select("vec_id", "label", "v", "code").mapInArrow(trimmed_stream(assign), row).write.parquet(path)
        if last:
            discard(spark, last)
        stored = spark.read.schema(row).parquet(path)
        state = stored.where(F.col("part").isNull())
        if step == rounds:
            break
        width = books.shape[2]
        changed = stored.where(F.col("part").isNotNull()).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.get("moved", F.lit(i))).alias(f"s{i}") for i in range(width)])
        for r in changed.collect():
            counts[r["part"], r["entry"]] += r["n"]
            sums[r["part"], r["entry"]] += [r[f"s{i}"] for i in range(width)]
        used = counts > 0
        books[used] = sums[used] // counts[used][:, None]

    coded = state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _pass(books: np.ndarray, kind: type):
    """A function of batches: entries renewed, and at the end the sums of what has moved."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(b.astype(kind)) for b in books]
        k, width = books.shape[1:]
        # Doubles hold these sums exactly for every block; blocks are added up as 64-bit numbers.
        moved, n = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        touched = np.zeros(books.shape[:2], bool)
        schema = None
        for block in _blocks(batches):
            schema = block.schema
            x = _rows(block, "v", kind).reshape(len(block), len(books), width)
            before = None
            if block.column("code").null_count == 0:
                before = np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8).reshape(len(block), -1).astype(np.int64)
            codes, error = np.zeros((len(block), len(books)), np.uint8), np.zeros(len(block), np.int64)
            for p, ball in enumerate(balls):
                part = np.ascontiguousarray(x[:, p])
                code, far = ball.nearest(part) if before is None else ball.renewed(part, before[:, p])
                codes[:, p] = code
                error += far.astype(np.int64)
                went = np.arange(len(part)) if before is None else np.flatnonzero(code != before[:, p])
                for sign, at in ((1, code), (-1, None if before is None else before[:, p])):
                    if at is None or not len(went):
                        continue
                    n[p] += sign * np.bincount(at[went], minlength=k)
                    touched[p, at[went]] = True
                    for i in range(width):
                        moved[p, :, i] += sign * np.bincount(at[went], weights=part[went, i], minlength=k).astype(np.int64)
            none = pa.nulls(len(block), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("label"), block.column("v"),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), none, none,
                 pa.nulls(len(block), pa.int64()), pa.nulls(len(block), pa.list_(pa.int64()))], names=_NAMES)
        if schema is not None and touched.any():
            part, entry = np.nonzero(touched)
            m = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, schema.field("vec_id").type), pa.nulls(m, schema.field("label").type),
                 pa.nulls(m, schema.field("v").type), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()),
                 pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[touched]),
                 pa.array(list(moved[touched]), pa.list_(pa.int64()))], names=_NAMES)

    return assign


_NAMES = ["vec_id", "label", "v", "code", "error", "part", "entry", "n", "moved"]


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, width: int = 16) -> str:
    """The same for tables named ``embeddings`` with ``parts`` times ``width`` components: every entry compared, round by round."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
comps AS MATERIALIZED (
  SELECT r, CAST(i // {width} AS INTEGER) AS part, CAST(i % {width} AS INTEGER) AS pos, v[i + 1] AS x
  FROM kept, range({parts * width}) t(i)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x FROM comps WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT r, part, min(d * {entries} + entry) % {entries} AS entry, min(d * {entries} + entry) // {entries} AS d FROM (
    SELECT p.r, part, c.entry, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d
    FROM comps p JOIN c{k} c USING (part, pos) GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce((s - (s % n + n) % n) // n, c.x) AS x
  FROM c{k} c LEFT JOIN (
    SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{k} JOIN comps USING (r, part) GROUP BY 1, 2, 3)
  USING (part, entry, pos))""")
    return f"""WITH {', '.join(steps)},
coded AS (
  SELECT r, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""
