"""Projections, filters and column detection."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.stats import null_counts, small_distinct_counts
from medlark.functions.types import (
    col, is_numeric, numeric_columns, other_columns, replace_columns, rows_from_struct,
)
from medlark.functions.values import hashed_distinct

# Columns with no information, after name normalization.
NOISE_COLUMNS = ["id", "unnamed:_0", "unnamed: 0", "unnamed:_32"]
# Columns tried as a label, in order.
LABEL_CANDIDATES = [
    "outcome", "target", "cardio", "stroke", "diagnosis_m", "diabetes_binary",
    "heartdiseaseorattack", "readmitted", "diabetes_012", "highbp",
]
# Words that mark an identifier.
ID_WORDS = [
    "id", "subject_id", "patient_id", "seqn", "sample", "name", "ssn", "mrn", "record",
    "row_id", "seq_no", "respondent", "hadm_id", "icustay_id", "encounter",
]
# Words that mark a quasi-identifier.
QUASI_ID_WORDS = [
    "age", "sex", "gender", "race", "ethnicity", "zip", "postal", "region", "state",
    "country", "education", "income", "occupation", "marital",
]
# Words that mark the value column of a series.
SERIES_VALUE_WORDS = ["new_cases", "total_cases", "new_deaths", "confirmed"]
# Words per meaning of a column.
MEANING_WORDS = {
    "age": ["age", "edad", "alter", "âge"],
    "sex": ["sex", "gender", "sexo", "geschlecht"],
    "bmi": ["bmi", "body_mass", "imc", "body_mass_index"],
    "blood_pressure": ["bp", "blood_pressure", "trestbps", "ap_hi", "ap_lo", "systolic",
                       "diastolic", "hypertension"],
    "cholesterol": ["chol", "cholesterol", "lipid", "ldl", "hdl"],
    "glucose": ["glucose", "gluc", "blood_sugar", "hba1c", "glycated"],
    "smoking": ["smoke", "smoker", "tobacco", "nicotine", "cigarette"],
    "alcohol": ["alco", "alcohol", "drink", "wine", "beer"],
    "physical_activity": ["active", "activity", "exercise", "phys", "fit"],
    "weight": ["weight", "kg", "kilo", "peso"],
    "height": ["height", "cm", "stature", "altura"],
    "diabetes": ["diabetes", "diabetic", "glucose", "insulin"],
    "heart_disease": ["heart", "cardio", "cardiac", "coronary", "mi", "infarct"],
    "cancer": ["cancer", "tumor", "malignant", "neoplasm"],
    "kidney": ["kidney", "renal", "creatinine", "gfr"],
    "liver": ["liver", "hepatic", "alt", "ast", "bilirubin"],
}
MAX_MISSING = 0.4
UNIQUE_SHARE = 0.95


def normalize_names(df: DataFrame) -> DataFrame:
    """Trimmed lower-case names with ``_`` for a space."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns with the same normalized name: {twice}")
    return df.toDF(*names)


def drop_noise_columns(df: DataFrame) -> DataFrame:
    return df.select([col(c) for c in df.columns if c not in NOISE_COLUMNS])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    rows, nulls = null_counts(df)
    return df.select([col(c) for c in df.columns if nulls[c] < rows])


def drop_sparse_columns(df: DataFrame, max_missing: float = MAX_MISSING) -> DataFrame:
    """Without the columns whose missing share is above ``max_missing``; equal stays."""
    rows, nulls = null_counts(df)
    if rows == 0:
        return df
    return df.select([col(c) for c in df.columns if nulls[c] / rows <= max_missing])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def drop_rows_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop("any", subset=cols)


def filter_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column contains the text, in any case; null is no match."""
    return df.where(F.coalesce(F.lower(col(column)).contains(text.lower()), F.lit(False)))


def parse_dates(df: DataFrame, column: str, formats: list[str] | None = None) -> DataFrame:
    """Text to timestamp without zone; what cannot be read becomes null."""
    c = col(column)
    if formats:
        parsed = F.coalesce(*[
            F.try_to_timestamp(c.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats])
    else:
        parsed = c.try_cast("timestamp_ntz")
    return replace_columns(df, {column: parsed})


def split_columns_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, other); a boolean is not numeric."""
    return numeric_columns(df), other_columns(df)


def column_kinds(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of every table: its kind and how many values it holds."""
    return _per_column(tables, lambda f: {"kind": "numeric" if is_numeric(f.dataType) else "other"})


def _per_column(tables: dict[str, DataFrame], describe) -> DataFrame | None:
    """(table_name, column_name, described fields, n_values); one aggregate per table over the columns that are described.

    None if there is none; a table without any is not read.
    """
    parts = []
    for name, df in tables.items():
        fields = [(f, d) for f in df.schema.fields if (d := describe(f))]
        if not fields:
            continue
        counts = df.agg(*[F.count(col(f.name)).alias(f"c{i}") for i, (f, _) in enumerate(fields)])
        structs = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in d.items()],
                F.col(f"c{i}").alias("n_values"),
            )
            for i, (f, d) in enumerate(fields)
        ]
        parts.append(rows_from_struct(counts, structs))
    return reduce(DataFrame.unionByName, parts) if parts else None


def pick_value_column(df: DataFrame, words: list[str] = SERIES_VALUE_WORDS) -> str:
    """First column whose name has one of the words, else the last numeric column."""
    for c in df.columns:
        if any(w in c.lower() for w in words):
            return c
    return numeric_columns(df)[-1]


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.fill(0, subset=cols or numeric_columns(df))


def recode(df: DataFrame, column: str, mapping: dict, into: str | None = None) -> DataFrame:
    """Map values by a small table; a value not in it becomes null."""
    c = col(column)
    expr = None
    for old, new in mapping.items():
        expr = F.when(c == F.lit(old), F.lit(new)) if expr is None \
            else expr.when(c == F.lit(old), F.lit(new))
    return replace_columns(df, {into or column: expr if expr is not None else F.lit(None)})


def presence_flag(df: DataFrame, column: str, into: str) -> DataFrame:
    return df.withColumn(into, col(column).isNotNull().cast("int"))


def body_measures(
    df: DataFrame, weight: str = "weight", height: str = "height",
    systolic: str = "ap_hi", diastolic: str = "ap_lo",
) -> DataFrame:
    """BMI from kg and cm, and pulse pressure; a height of zero gives null."""
    metres = col(height) / F.lit(100.0)
    return df.select(
        "*",
        F.try_divide(col(weight).cast("double"), metres * metres).alias("bmi"),
        (col(systolic) - col(diastolic)).alias("pulse_pressure"),
    )


def stay_features(df: DataFrame, start: str, end: str) -> DataFrame:
    """Whole days of the stay, and month, weekday (Monday 0) and weekend flag of the start."""
    day = F.weekday(col(start))

    def clock(c: str) -> Column:
        return F.hour(col(c)) * 3600 + F.minute(col(c)) * 60 + F.extract(F.lit("SECOND"), col(c))

    # Whole days between the two, so 23 hours over midnight are 0 days.
    short = (clock(end) < clock(start)).cast("int")
    return df.select(
        "*",
        (F.datediff(col(end), col(start)) - short).alias("los_days"),
        F.month(col(start)).alias("admission_month"),
        day.alias("admission_weekday"),
        day.isin(5, 6).cast("int").alias("is_weekend"),
    )


def align_schema(df: DataFrame, cols: list[str], fill=0, types: dict[str, T.DataType] | None = None
                 ) -> DataFrame:
    """Exactly ``cols``; made-up columns hold ``fill``, nulls already there stay."""
    types = types or {}
    have = set(df.columns)
    return df.select([
        col(c) if c in have
        else (F.lit(fill).cast(types[c]) if c in types else F.lit(fill)).alias(c)
        for c in cols
    ])


def affix_names(df: DataFrame, prefix: str = "", suffix: str = "", keep: list[str] = ()) -> DataFrame:
    """Prefix or suffix on every column name but the kept ones."""
    return df.toDF(*[c if c in keep else f"{prefix}{c}{suffix}" for c in df.columns])


def detect_label(df: DataFrame, candidates: list[str] = LABEL_CANDIDATES) -> str | None:
    """First listed column with 2 to 10 distinct values."""
    have = [c for c in candidates if c in df.columns]
    counts = small_distinct_counts(df, have, limit=10)
    return next((c for c in have if 2 <= counts[c] <= 10), None)


def _squeeze(text: str) -> str:
    return re.sub(r"[_\-]", "", text.lower())


def name_matches(name: str, words: list[str], match: str = "token") -> bool:
    """``token``: a word is a run of whole ``_``/``-`` parts of the name.

    ``substring``: a word occurs anywhere once ``_`` and ``-`` are removed from both.
    """
    if match == "substring":
        return any(_squeeze(w) in _squeeze(name) for w in words)
    parts = "_" + re.sub(r"[_\-\s]+", "_", name.lower()) + "_"
    return any("_" + re.sub(r"[_\-\s]+", "_", w.lower()) + "_" in parts for w in words)


def id_ratios(df: DataFrame, exact_from: float = 0.85) -> dict[str, float]:
    """Distinct values over rows for text columns; by hashes for those the sketch puts near 0.95."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return {}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.approx_count_distinct(col(c), 0.02).alias(f"d{i}") for i, c in enumerate(text)]).first()
    rows = row["rows"]
    if rows == 0:
        return {c: 0.0 for c in text}
    ratios = {c: min(1.0, row[f"d{i}"] / rows) for i, c in enumerate(text)}
    near = [c for c in text if ratios[c] >= exact_from]
    if near:
        ratios.update({near[r["i"]]: r["n"] / rows for r in hashed_distinct(df, near).collect()})
    return ratios


def detect_id_columns(df: DataFrame, match: str = "token") -> list[str]:
    """Columns named like an identifier, or text columns that are nearly unique."""
    named = {c for c in df.columns if name_matches(c, ID_WORDS, match)}
    rest = df.select([col(c) for c in df.columns if c not in named])
    ratios = id_ratios(rest) if rest.columns else {}
    return [c for c in df.columns if c in named or ratios.get(c, 0.0) > UNIQUE_SHARE]


def detect_quasi_ids(df: DataFrame, match: str = "token") -> list[str]:
    return [c for c in df.columns if name_matches(c, QUASI_ID_WORDS, match)]


def column_catalog(
    tables: dict[str, DataFrame], patterns: dict[str, list[str]] = MEANING_WORDS,
    match: str = "token",
) -> DataFrame:
    """(category, table_name, column_name, n_values), a column once per matching category."""
    def describe(f):
        found = [cat for cat, words in patterns.items() if name_matches(f.name, words, match)]
        return {"categories": F.array(*map(F.lit, found))} if found else None

    listed = _per_column(tables, describe)
    if listed is None:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "category string, table_name string, column_name string, n_values long")
    return listed.select(F.explode("categories").alias("category"),
                         "table_name", "column_name", "n_values")


def drop_constant_categories(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Without non-numeric columns that have at most one distinct value."""
    cols = other_columns(df) if cols is None else cols
    counts = small_distinct_counts(df, cols, limit=1)
    return df.select([col(c) for c in df.columns if counts.get(c, 2) > 1])
