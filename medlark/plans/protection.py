"""Cleaned table to a table that may be shared."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from medlark.functions.types import numeric_columns
from medlark.operators import privacy
from medlark.operators.columns import detect_id_columns, detect_quasi_ids, name_matches
from medlark.operators.privacy import Release
from medlark.plans.batch import each_table


class Protected(NamedTuple):
    table: DataFrame
    k_before: DataFrame
    k_after: DataFrame
    release: DataFrame | None
    utility: DataFrame


def protect_table(
    df: DataFrame, id_cols: list[str], quasi_ids: list[str], ages: list[str] = (),
    *, salt: str, k: int = privacy.K, release_by: list[str] = (),
    release: dict[str, Release] | None = None, eps: float = privacy.EPSILON,
) -> Protected:
    """Pseudonyms, bands, group sizes before and after small groups go, noisy statistics, lost utility.

    Groups are measured on the bands and before any noise. Noise goes on
    published statistics, not on the cells. All quasi-ids count. The salt is secret and new for every release.
    """
    table = privacy.pseudonymize(df, id_cols, salt=salt)
    for c in ages:
        table = privacy.age_bands(table, c)
    used = []
    for c in quasi_ids:
        if c in ages:
            used.append(f"{c}_group")
            continue
        table = privacy.quantile_bands(table, c)
        used.append(c if c in table.columns else f"{c}_bin")
    before = privacy.k_anonymity(table, used, k)
    kept = privacy.enforce_k(table, used, k)
    noisy = privacy.dp_aggregate(df, list(release_by), release, salt, eps) if release else None
    return Protected(kept, before, privacy.k_anonymity(kept, used, k), noisy,
                     privacy.utility_report(df, kept))


def protect_tables(
    spark: SparkSession, tables: dict[str, DataFrame], out: str, run: str, *, salt: str,
    k: int = privacy.K,
) -> dict[str, str]:
    """Protect every table to ``out/<name>_protected``, its columns found by name and uniqueness."""
    def plan(df: DataFrame) -> DataFrame:
        ids = detect_id_columns(df)
        quasi = [c for c in detect_quasi_ids(df) if c not in ids]
        numbers = set(numeric_columns(df))
        ages = [c for c in quasi if c in numbers and name_matches(c, ["age"])]
        if not quasi:
            return privacy.pseudonymize(df, ids, salt=salt)
        return protect_table(df, ids, quasi, ages, k=k, salt=salt).table

    return each_table(spark, tables, out, run, "_protected", plan)
