"""Raw table to cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlark.functions.quantiles import filled_with_median
from medlark.functions.stats import null_counts
from medlark.functions.storage import cut_lineage
from medlark.functions.types import col, nan_to_null, numeric_columns, other_columns, replace_columns
from medlark.functions.values import TextValues
from medlark.operators import clean, columns
from medlark.operators.combine import dedupe
from medlark.operators.profile import UNKNOWN
from medlark.plans.batch import each_table


def clean_table(
    df: DataFrame, keep: list[str] = (), key: str | None = None, impute: str = "mice",
    outliers: str = "iqr", scaling: str = "standard", max_missing: float = columns.MAX_MISSING,
) -> DataFrame:
    """Names, useless columns, duplicates, missing values, outliers, encoding, scaling.

    Columns in ``keep`` (keys and labels) are neither clipped, encoded nor scaled. The table is stored once, after the only
    wide shuffle (removing duplicates). With ``impute="median"`` six scans of it are enough for any width: nulls, three for exact
    quantiles of all numbers, one for the values of all texts, one for scaling; what a number column is after its
    fill is worked out from what it was before. ``mice`` and ``knn`` add theirs, and ``knn`` stores the filled table.
    """
    if outliers not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier rule {outliers!r}")
    if scaling not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling {scaling!r}")
    named = columns.normalize_names(df)
    keep = [k.strip().lower().replace(" ", "_") for k in keep]
    named = named.select([c for c in named.columns if c not in columns.NOISE_COLUMNS or c in keep])
    stored = cut_lineage(dedupe(columns.drop_null_columns(named)))
    rows, nulls = null_counts(stored)
    table = stored.select([col(c) for c in stored.columns if not rows or nulls[c] / rows <= max_missing])
    table = columns.drop_empty_rows(table)
    numbers = [c for c in numeric_columns(table) if c not in keep]
    texts = [c for c in other_columns(table) if c not in keep]

    values = TextValues(table, texts) if texts else None
    modes = {c: F.lit(values.mode[c] if values.mode[c] is not None else UNKNOWN).try_cast(table.schema[c].dataType) for c in texts}
    if impute == "median":
        missing = {c: nulls[c] / rows for c in numbers} if rows else {}
        filled = filled_with_median(nan_to_null(table), numbers, [0.25, 0.75], missing)
        table = replace_columns(table, {
            **{c: F.coalesce(F.nanvl(col(c).cast("double"), F.lit(None).cast("double")), F.lit(f.median))
               for c, f in filled.items() if f.n}, **{c: F.coalesce(col(c), m) for c, m in modes.items()}})
        bounds = clean.bounds_of_filled(filled, outliers)
    else:
        table = clean.impute_auto(table, numbers, impute, key)
        if impute == "knn":
            # Its fills come from a join; bounds, codes and scaling scan the filled table again and again.
            table = cut_lineage(table)
        table = replace_columns(table, {c: F.coalesce(col(c), m) for c, m in modes.items()})
        bounds = clean.iqr_bounds(table, numbers) if outliers == "iqr" else clean.zscore_bounds(table, numbers)
    table = clean.clip_to(table, bounds)
    before = set(table.columns)
    if values:
        values.add_missing({c: UNKNOWN for c in texts if values.mode[c] is None and rows})
        table = clean.encode_auto(table, texts, values)
    # Indicator columns stay 0/1; ranks and 0/1 codes that replaced a column are scaled.
    scaled = [c for c in numeric_columns(table) if c in before and c not in keep]
    return clean.scale_standard(table, scaled) if scaling == "standard" else clean.scale_minmax(table, scaled)


def clean_tables(
    spark: SparkSession, tables: dict[str, DataFrame], out: str, run: str, **options,
) -> dict[str, str]:
    """Clean every table to ``out/<name>_cleaned`` and log one audit row each."""
    return each_table(spark, tables, out, run, "_cleaned", lambda df: clean_table(df, **options))
