"""Pseudonyms, noise, group-size checks and generalization."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.hashing import keyed_laplace, keyed_uniform, short_digest
from medlark.functions.quantiles import exact_quantiles
from medlark.functions.stats import column_stats, small_distinct_counts
from medlark.functions.types import col, numeric_columns, replace_columns
from medlark.operators.columns import detect_id_columns, detect_quasi_ids
from medlark.operators.profile import corr_matrix, group_size_profile

# Fixed values of the privacy settings.
EPSILON = 1.0
SENSITIVITY = 1.0
K = 5
DIGEST_LENGTH = 16
AGE_EDGES = [18, 30, 40, 50, 60, 70, 80]
AGE_LABELS = ["<18", "18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+"]
QUANTILE_BANDS = 5
MIN_DISTINCT = 20


def pseudonymize(df: DataFrame, cols: list[str] | None = None, length: int = DIGEST_LENGTH,
                 salt: str = "") -> DataFrame:
    """``c`` becomes ``c_hash``, the start of SHA-256 of its text.

    Without a salt anyone who can guess a value can find its pseudonym.
    """
    cols = detect_id_columns(df) if cols is None else cols
    return df.select(*[col(c) for c in df.columns if c not in cols],
                     *[short_digest(col(c), length, salt).alias(f"{c}_hash") for c in cols])


def laplace_noise(df: DataFrame, cols: list[str], key: list[str], salt: str,
                  eps: float = EPSILON, sens: float = SENSITIVITY) -> DataFrame:
    """Laplace noise on every cell of ``cols``, null as 0; the same row key gives the same noise.

    ``salt`` must be secret and new for every release. This is local noise on
    cells; it carries no privacy claim for the whole table.
    """
    return replace_columns(df, {
        c: F.coalesce(col(c).cast("double"), F.lit(0.0))
        + keyed_laplace(*[col(k) for k in key], F.lit(c), salt=salt, scale=sens / eps)
        for c in cols})


def noise_report(df: DataFrame, cols: list[str], key: list[str], salt: str,
                 eps: float = EPSILON, sens: float = SENSITIVITY) -> DataFrame:
    """(column_name, noise_mean, noise_std) of the noise :func:`laplace_noise` adds."""
    noise = df.select([
        keyed_laplace(*[col(k) for k in key], F.lit(c), salt=salt, scale=sens / eps).alias(c)
        for c in cols])
    one = noise.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}"))])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("noise_mean"),
                 F.col(f"s{i}").alias("noise_std")) for i, c in enumerate(cols)])).alias("r")
    ).select("r.*")


class Release(NamedTuple):
    """One statistic to publish. Values are clipped to ``lo..hi`` before they are summed."""

    kind: str
    column: str | None = None
    lo: float = 0.0
    hi: float = 1.0

    @property
    def sensitivity(self) -> float:
        return 1.0 if self.kind == "count" else max(abs(self.lo), abs(self.hi))

    def expression(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1)).cast("double")
        if self.kind == "sum":
            c = col(self.column)
            clipped = F.least(F.greatest(c, F.lit(self.lo)), F.lit(self.hi))
            return F.coalesce(F.sum(F.when(c.isNotNull(), clipped)), F.lit(0.0))
        raise ValueError(f"unknown statistic {self.kind!r}")


class BudgetSpent(ValueError):
    """A release would spend more than what is left of the total."""


class Ledger:
    """What releases of one table have spent, kept as rows in a folder, so that later programs know of earlier ones.

    A release is claimed before its figures are worked out. Claims count in the order in which they were made; one that
    does not fit is refused and counts nothing. Of two claims made at once, both see both.
    """

    SCHEMA = "claim string, made timestamp, what string, eps double"

    def __init__(self, spark: SparkSession, path: str, total: float):
        self.spark, self.path, self.total = spark, path, total

    def claims(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).option("pathGlobFilter", "*.parquet").parquet(self.path)

    def spent(self) -> float:
        return self._accepted()[1]

    def _accepted(self) -> tuple[set[str], float]:
        """Claims are as few as releases."""
        try:
            rows = self.claims().orderBy("made", "claim").collect()
        except AnalysisException:
            rows = []
        held, spent = set(), 0.0
        for r in rows:
            if spent + r["eps"] <= self.total * (1 + 1e-9):
                held.add(r["claim"])
                spent += r["eps"]
        return held, spent

    def claim(self, what: str, eps: float) -> None:
        """Spend ``eps``, or raise :class:`BudgetSpent`."""
        if not eps > 0:
            raise ValueError("a release costs more than nothing")
        name = uuid.uuid4().hex
        row = self.spark.range(1).select(F.lit(name).alias("claim"), F.current_timestamp().alias("made"),
                                         F.lit(what).alias("what"), F.lit(float(eps)).alias("eps"))
        row.coalesce(1).write.mode("append").parquet(self.path)
        held, spent = self._accepted()
        if name not in held:
            raise BudgetSpent(f"{what} costs {eps}, {self.total - spent} of {self.total} are left")


def bounded_rows(df: DataFrame, person: list[str], most_rows: int, key: list[str], salt: str) -> DataFrame:
    """At most ``most_rows`` rows of a person, the first in an order drawn by key; a task passes on no more than these.

    Null persons are one person.
    """
    order = Window.partitionBy(*[col(p) for p in person]).orderBy(
        keyed_uniform(*[col(k) for k in key], salt=salt), *[col(k) for k in key])
    ranked = df.select("*", F.row_number().over(order).alias("_turn")).where(F.col("_turn") <= most_rows)
    return ranked.select([col(c) for c in df.columns])


def dp_aggregate(df: DataFrame, by: list[str], aggs: dict[str, Release], salt: str,
                 eps: float = EPSILON, person: list[str] | None = None, most_rows: int = 1,
                 key: list[str] | None = None, ledger: Ledger | None = None) -> DataFrame:
    """Noisy counts and sums per group. ``eps`` is split evenly over the statistics.

    With ``person``, at most ``most_rows`` rows of each one count (a draw by ``key``), and the noise covers so many; without,
    the table must have one row per person. A ``ledger`` is charged first and refuses what goes beyond its total. Which
    groups exist is not hidden; publish groups from a fixed list where that matters.
    """
    if person is None and most_rows != 1:
        raise ValueError("rows of a person can be bounded only if the person is known")
    if person is not None:
        if not key:
            raise ValueError("the rows of a person are drawn by a key")
        df = bounded_rows(df, person, most_rows, key, salt)
    if ledger is not None:
        ledger.claim(f"{', '.join(aggs)} by {', '.join(by)}", eps)
    share = eps / len(aggs)
    grouped = df.groupBy(*[col(b) for b in by]).agg(
        *[r.expression().alias(name) for name, r in aggs.items()])
    return replace_columns(grouped, {
        name: col(name) + keyed_laplace(*[col(b) for b in by], F.lit(name), salt=salt,
                                        scale=most_rows * r.sensitivity / share)
        for name, r in aggs.items()})


def k_anonymity(df: DataFrame, quasi_ids: list[str] | None = None, k: int = K) -> DataFrame:
    """One row: smallest and mean group, groups, groups below ``k``; -1 without quasi-ids.

    All quasi-ids count; rows with a null one are left out.
    """
    found = detect_quasi_ids(df) if quasi_ids is None else quasi_ids
    used = [c for c in found if c in df.columns]
    if not used:
        return df.limit(0).agg(F.lit(-1).cast("long").alias("k_min"),
                               F.lit(None).cast("double").alias("k_mean"),
                               F.lit(0).cast("long").alias("n_groups"),
                               F.lit(0).cast("long").alias("n_violations"))
    p = group_size_profile(df.na.drop(subset=used), [col(c) for c in used], k)
    return p.select(F.col("size_min").alias("k_min"), F.col("size_mean").alias("k_mean"),
                    "n_groups", F.col("n_below_k").alias("n_violations"))


def k_violations(df: DataFrame, quasi_ids: list[str], k: int = K) -> DataFrame:
    """The groups smaller than ``k`` with their sizes."""
    return (df.na.drop(subset=quasi_ids).groupBy(*[col(c) for c in quasi_ids])
            .agg(F.count(F.lit(1)).alias("size")).where(F.col("size") < k))


def age_band(c: Column) -> Column:
    """Right-closed bands: 18 is ``<18``, 30 is ``18-29``; null counts as 0."""
    age = F.coalesce(c.cast("double"), F.lit(0.0))
    out = None
    for edge, label in zip(AGE_EDGES, AGE_LABELS):
        out = F.when(age <= edge, label) if out is None else out.when(age <= edge, label)
    return out.otherwise(AGE_LABELS[-1])


def age_bands(df: DataFrame, column: str) -> DataFrame:
    """``c`` becomes ``c_group``."""
    return df.select(*[col(c) for c in df.columns if c != column],
                     age_band(col(column)).alias(f"{column}_group"))


def quantile_bands(df: DataFrame, column: str, q: int = QUANTILE_BANDS, digits: int = 3) -> DataFrame:
    """``c`` becomes ``c_bin``, the label ``(lo, hi]`` of its quantile interval; null as 0.

    Equal edges are merged and the lowest edge is let down a little so that the
    minimum is inside. Columns that are not floating point or have at most 20
    distinct values stay.
    """
    if not isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return df
    if small_distinct_counts(df, [column], limit=MIN_DISTINCT)[column] <= MIN_DISTINCT:
        return df
    x = F.coalesce(col(column).cast("double"), F.lit(0.0))
    edges = sorted(set(exact_quantiles(df, {"x": x}, [i / q for i in range(q + 1)])["x"]))
    shown = [round(e, digits) for e in edges]
    shown[0] = round(shown[0] - 10.0 ** -digits, digits)
    labels = [f"({a}, {b}]" for a, b in zip(shown, shown[1:])]
    band = None
    for edge, label in zip(edges[1:-1], labels):
        band = F.when(x <= F.lit(edge), label) if band is None else band.when(x <= F.lit(edge), label)
    band = F.lit(labels[-1]) if band is None else band.otherwise(labels[-1])
    return df.select(*[col(c) for c in df.columns if c != column], band.alias(f"{column}_bin"))


def utility_report(original: DataFrame, protected: DataFrame, cols: list[str] | None = None
                   ) -> DataFrame:
    """One row: mean absolute change of correlations, means and sample stds.

    All over the shared numeric columns. The status is ``insufficient_data`` below two of them.
    """
    shared = sorted(set(numeric_columns(original)) & set(numeric_columns(protected)))
    shared = [c for c in shared if cols is None or c in cols]
    spark = original.sparkSession
    schema = ("status string, correlation_mae double, avg_mean_diff double, "
              "avg_std_diff double, n_columns bigint")
    if len(shared) < 2:
        return spark.createDataFrame([("insufficient_data", None, None, None, len(shared))], schema)
    before, after = corr_matrix(original, shared), corr_matrix(protected, shared)
    both = before.join(after.withColumnRenamed("r", "r2"), ["a", "b"])
    corr = both.agg(F.avg(F.abs(F.col("r") - F.col("r2"))).alias("correlation_mae"))
    a = column_stats(original, shared, ["mean", "std"])
    b = column_stats(protected, shared, ["mean", "std"])

    def mean_change(what: str) -> float:
        return sum(abs(a[c][what] - b[c][what]) for c in shared) / len(shared)

    return corr.select(
        F.lit("ok").alias("status"), "correlation_mae",
        F.lit(mean_change("mean")).alias("avg_mean_diff"),
        F.lit(mean_change("std")).alias("avg_std_diff"),
        F.lit(len(shared)).cast("long").alias("n_columns"))


def enforce_k(df: DataFrame, quasi_ids: list[str], k: int = K) -> DataFrame:
    """Only rows whose quasi-id group has at least ``k`` rows; null is a value of its own.

    Group sizes are counted with partial sums and the small groups are taken
    out by an anti-join, so a huge group never sits in one task.
    """
    names = [f"_k{i}" for i in range(len(quasi_ids))] + ["_nulls"]
    nulls = F.lit(0)
    for i, c in enumerate(quasi_ids):
        nulls = nulls + col(c).isNull().cast("int") * F.lit(2**i)
    keyed = df.select("*", *[F.coalesce(col(c).cast("string"), F.lit("")).alias(f"_k{i}")
                             for i, c in enumerate(quasi_ids)], nulls.alias("_nulls"))
    small = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < k)
    return keyed.join(small.drop("_n"), names, "left_anti").drop(*names)
