"""Column classes read off the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(t: T.DataType) -> bool:
    """Integers, floats and decimals; a boolean is not a number."""
    return isinstance(t, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in a float column becomes null, so that counts and means skip it."""
    floats = {
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    if not floats:
        return df
    return df.select([
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(quoted(c)).alias(c)
        for c in df.columns
    ])


def quoted(name: str) -> str:
    """Column name safe for names with dots and spaces."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def micros(df: DataFrame, name: str) -> Column:
    """A date, time or number as a double that sorts the same way, whatever the session time zone."""
    t, c = df.schema[name].dataType, col(name)
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(t, (T.DateType, T.TimestampNTZType)):
        days = F.unix_date(c.cast("date")) * F.lit(86_400e6)
        if isinstance(t, T.DateType):
            return days
        seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)
        midnight = c == c.cast("date").cast("timestamp_ntz")
        return F.when(midnight, days).otherwise(days + seconds.cast("double") * F.lit(1e6))
    return c.cast("double")


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """One projection that swaps the given columns in place and keeps the rest."""
    known = set(df.columns)
    kept = [new[c].alias(c) if c in new else col(c) for c in df.columns]
    return df.select(*kept, *[e.alias(c) for c, e in new.items() if c not in known])


def rows_from_struct(df: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn a one-row frame into one row per struct (wide to long)."""
    return df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
