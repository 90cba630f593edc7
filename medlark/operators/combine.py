"""Joining and stacking of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.hashing import keyed_uniform
from medlark.functions.joins import hot_outer_chain, outer_join
from medlark.functions.ranking import line_numbers
from medlark.functions.types import col, is_numeric, quoted
from medlark.operators.columns import affix_names, align_schema

# Columns that must be shared for stacking on common columns.
MIN_COMMON = 3
# The tables of each subject domain.
DOMAINS = {
    "chronic_disease": [
        "brfss_diabetes__diabetes_binary_health_indicators_BRFSS2015",
        "brfss_heart__heart_disease_health_indicators_BRFSS2015",
        "cardio_disease__cardio_train",
        "stroke_prediction__healthcare-dataset-stroke-data",
        "pima_diabetes__diabetes",
        "chronic_disease__chronic_disease_dataset",
    ],
    "clinical_risk": [
        "heart_disease__heart",
        "heart_cleveland__processed.cleveland",
        "heart_hungarian__processed.hungarian",
        "breast_cancer__data",
        "cervical_cancer__risk_factors_cervical_cancer",
    ],
    "population_health": [
        "who__NCD_BMI_MEAN", "who__LIFE_0000000035", "who__NCDMORT3070",
        "who__SA_0000001688", "nhanes__merged",
    ],
    "healthcare_ops": [
        "healthcare_ops__healthcare_dataset",
        "medical_insurance__insurance",
        "diabetes_130us__dataset_diabetes__diabetic_data",
    ],
    "covid_timeseries": [
        "covid_india__complete", "covid_india__patients_data",
        "covid_india__nation_level_daily", "covid_india__state_level_daily",
    ],
}


def merge_surveys(tables: dict[str, DataFrame], key: str = "seqn") -> DataFrame:
    """Full outer join of survey parts on the person key.

    A table is named ``PART`` or ``PART_CYCLE``. Cycles of a part are stacked
    first, then parts are joined; every column but the key ends in ``_PART``.
    Tables without the key are left out. Null keys match nothing.
    """
    parts: dict[str, list[DataFrame]] = {}
    for name, df in tables.items():
        found = next((c for c in df.columns if c.lower() == key.lower()), None)
        if found is None:
            continue
        part = name.split("_")[0]
        parts.setdefault(part, []).append(
            affix_names(df.withColumnRenamed(found, key), suffix=f"_{part}", keep=[key]))
    if not parts:
        raise ValueError(f"no table has the key {key!r}")
    stacked = [
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cycles)
        for cycles in parts.values()
    ]
    return hot_outer_chain(stacked, [key])


def zip_samples(
    tables: dict[str, DataFrame], keys: dict[str, list[str]], n: int | None = None, seed: str = "42",
) -> DataFrame:
    """Samples of equal size side by side, by position in hash order.

    The size is that of the smallest table, or ``n`` if given and less. Rows of different
    tables in one line have nothing to do with each other; use
    :func:`join_by_respondent` where there is a shared key.
    """
    sizes = {name: df.count() for name, df in tables.items()}
    size = min(sizes.values()) if n is None else min([n, *sizes.values()])
    numbered = []
    for name, df in tables.items():
        drawn = df.withColumn("_u", keyed_uniform(*[col(k) for k in keys[name]], salt=seed))
        lined = line_numbers(drawn, "_u", keys[name], "_at", sizes[name]).where(F.col("_at") <= size).drop("_u")
        numbered.append(affix_names(lined, prefix=f"{name}_", keep=["_at"]))
    joined = reduce(lambda a, b: a.join(b, "_at"), numbered)
    return joined.withColumnRenamed("_at", "position")


def join_by_respondent(demo: DataFrame, health: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Two survey parts of the same person, joined on the person key.

    Adaptive execution splits a person with a great share of the rows; for a full join such rows go apart.
    """
    if how == "inner":
        return health.join(demo, key, "inner")
    if how == "left":
        return demo.join(health, key, "left")
    return outer_join(demo, health, [key])


def _common_type(types: list[T.DataType]) -> T.DataType:
    """The one type, double for mixed numbers, else text."""
    if all(t == types[0] for t in types):
        return types[0]
    return T.DoubleType() if all(is_numeric(t) for t in types) else T.StringType()


def _stack(tables: list[DataFrame], cols: list[str]) -> DataFrame:
    types = {
        c: _common_type([f.dataType for df in tables for f in df.schema.fields if f.name == c])
        for c in cols
    }
    aligned = [align_schema(df, cols, 0, types) for df in tables]
    cast = [df.select([F.col(quoted(c)).cast(types[c]).alias(c) for c in cols]) for df in aligned]
    return reduce(lambda a, b: a.unionByName(b), cast)


def common_columns(tables: list[DataFrame]) -> list[str]:
    return sorted(set.intersection(*[set(df.columns) for df in tables]))


def union_common(tables: list[DataFrame], min_common: int = MIN_COMMON) -> DataFrame:
    """Stack on the columns all tables share, in name order."""
    cols = common_columns(tables)
    if len(cols) < min_common:
        raise ValueError(f"only {len(cols)} shared columns")
    return _stack(tables, cols)


def union_all_columns(tables: list[DataFrame]) -> DataFrame:
    """Stack on all columns of any table, in name order; made-up cells are 0."""
    return _stack(tables, sorted(set().union(*[df.columns for df in tables])))


def dedupe(df: DataFrame) -> DataFrame:
    """Without exact duplicate rows; copies are folded before the shuffle."""
    return df.dropDuplicates()


def removed_duplicates(df: DataFrame) -> DataFrame:
    """(copies, rows, removed) per number of copies above one: how many rows come so often, and what ``dedupe`` takes out.

    Rows are told apart by 128 bits of hash of all cells, so no wide row is exchanged.
    """
    # Hashes skip nulls, so which cells are null is hashed too.
    parts = [*[col(c) for c in df.columns], *[col(c).isNull() for c in df.columns]]
    hashed = df.select(F.xxhash64(*parts).alias("_a"), F.xxhash64(F.lit("b"), *parts).alias("_b"))
    counted = hashed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    return counted.groupBy("copies").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("copies") - 1).alias("removed"))


def fuse_domain(
    tables: dict[str, DataFrame], domains: dict[str, list[str]] = DOMAINS,
) -> tuple[dict[str, DataFrame], dict[str, str], list[str]]:
    """Stack the tables of each domain.

    Returns the stacked tables, the way each was stacked (``single``,
    ``common_cols`` or ``all_cols``) and the names no domain asked for.
    """
    fused, methods, used = {}, {}, set()
    for domain, names in domains.items():
        members = [tables[n] for n in names if n in tables]
        used.update(n for n in names if n in tables)
        if not members:
            continue
        if len(members) == 1:
            fused[domain], methods[domain] = members[0], "single"
        elif len(common_columns(members)) >= MIN_COMMON:
            fused[domain], methods[domain] = union_common(members), "common_cols"
        else:
            fused[domain], methods[domain] = union_all_columns(members), "all_cols"
    return fused, methods, [n for n in tables if n not in used]
