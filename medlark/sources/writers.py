"""Stage sinks and the audit log."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.types import col

AUDIT_SCHEMA = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_before", T.LongType()),
    T.StructField("cols_before", T.LongType()),
    T.StructField("rows_after", T.LongType()),
    T.StructField("cols_after", T.LongType()),
    T.StructField("missing_rate", T.DoubleType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("size_kb", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """Text with a header in every part file."""
    df.write.mode(mode).options(header=True, sep=sep, emptyValue="").csv(path)


def append_audit(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Add one audit row per table of a run. A missing entry is null."""
    names = AUDIT_SCHEMA.fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    spark.createDataFrame(data, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def table_metrics(df: DataFrame, duplicates: bool = True) -> DataFrame:
    """One row: rows, columns, worst missing share of a column, exact duplicate rows.

    Duplicates are rows less distinct 128-bit row hashes, so no wide row is shuffled.
    """
    cols = df.columns
    nulls = [col(c).isNull() for c in cols]
    # Hashes skip nulls, so which cells are null is hashed too.
    parts = [*[col(c) for c in cols], *nulls]
    hashed = df.select(*[n.cast("int").alias(f"_m{i}") for i, n in enumerate(nulls)],
                       F.xxhash64(*parts).alias("_a"), F.xxhash64(F.lit("b"), *parts).alias("_b"))
    rows = F.count(F.lit(1))
    missing = [F.sum(f"_m{i}") for i in range(len(cols))]
    worst = F.greatest(*missing) if len(missing) > 1 else missing[0]
    return hashed.agg(
        rows.alias("rows"),
        F.lit(len(cols)).cast("long").alias("cols"),
        F.coalesce(F.try_divide(worst, rows), F.lit(0.0)).alias("missing_rate"),
        (rows - F.count_distinct("_a", "_b") if duplicates else F.lit(0)).cast("long").alias("duplicates"),
    )


def files_kb(spark: SparkSession, path: str) -> float:
    """Size of the files of a stored table; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return (files.agg(F.sum("length")).first()[0] or 0) / 1024


def audit_rows(tables: dict[str, DataFrame], run: str, at_once: int = 8) -> list[dict]:
    """Measure several tables; their jobs are independent and run side by side."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda t: audit_row(t[1], t[0], run), tables.items()))


def audit_row(df: DataFrame, table: str, run: str, before: tuple[int, int] | None = None,
              status: str = "ok", path: str | None = None) -> dict:
    """Measure a finished table for :func:`append_audit`; ``path``, where it is stored, gives its size."""
    m = table_metrics(df).first()
    rows, cols = before or (m["rows"], m["cols"])
    return dict(run=run, table_name=table, status=status, rows_before=rows, cols_before=cols,
                rows_after=m["rows"], cols_after=m["cols"],
                missing_rate=round(m["missing_rate"], 4), duplicates=m["duplicates"],
                size_kb=None if path is None else round(files_kb(df.sparkSession, path), 2))
