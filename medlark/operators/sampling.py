"""Fixed-size samples and top-k reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.functions.hashing import keyed_uniform
from medlark.functions.types import col


def sample_rows(
    df: DataFrame, n: int, key: list[str], seed: str = "42", rows: int | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """The ``n`` rows with the smallest keyed hash; all rows if there are no more.

    A hash limit that lets a few more than ``n`` rows through comes first, so
    the final sort sees about ``n`` rows however big the table is. The limit
    is checked by a count and dropped if it let too few through.
    """
    if rows is None:
        rows = df.count()
    drawn = df.withColumn("_u", keyed_uniform(*[col(k) for k in key], salt=seed))
    if rows > n:
        limit = (n + 10 * math.sqrt(n) + 100) / rows
        if limit < 1.0:
            few = drawn.where(F.col("_u") < limit)
            if few.limit(n).count() >= n:
                drawn = few
        drawn = drawn.orderBy("_u", *[col(k) for k in key]).limit(n)
    return drawn if keep_order else drawn.drop("_u")


def top_features(importance: DataFrame, n: int, value: str = "importance", name: str = "feature"
                 ) -> DataFrame:
    """The ``n`` highest importances; equal ones in name order."""
    return importance.orderBy(F.desc(value), F.asc(name)).limit(n)
