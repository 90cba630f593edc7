"""Reading delimited text, headerless text, JSON records, Parquet and whole trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.types import nan_to_null, quoted

# Files a tree scan leaves out.
SKIPPED_SUFFIXES = (".zip", ".jpeg", ".png", ".jpg", ".log", ".json")
SKIPPED_FOLDERS = ("__MACOSX",)
# The 14 columns of the headerless heart tables.
HEART_COLUMNS = [
    "age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalach",
    "exang", "oldpeak", "slope", "ca", "thal", "target",
]


def sniff_separator(first_line: str) -> str:
    """``;`` if it beats comma and tab, else tab if it beats comma, else comma."""
    semicolons, tabs, commas = (first_line.count(c) for c in ";\t,")
    if semicolons > max(commas, tabs):
        return ";"
    return "\t" if tabs > commas else ","


def sniff_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line is valid UTF-8, else Latin-1, which accepts any byte.

    One distributed pass that stops at the first bad line.
    """
    lines = spark.read.text(path)
    bad = lines.where(~F.is_valid_utf8("value")).limit(1).count()
    return "ISO-8859-1" if bad else "UTF-8"


def read_delimited(
    spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Text with a header line. Pass ``schema`` for big files: inference is one more scan."""
    if sep is None:
        line = spark.read.text(path).limit(1).first()
        sep = sniff_separator(line["value"] if line else "")
    reader = spark.read.options(
        header=True, sep=sep, encoding=encoding or sniff_encoding(spark, path), nanValue="NaN",
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return nan_to_null(df.toDF(*[c.lstrip("\ufeff") for c in df.columns]))


def read_headerless(
    spark: SparkSession, path: str, names: list[str], schema: T.StructType | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Text without a header; the caller names the columns."""
    reader = spark.read.options(header=False, sep=sep, nullValue="")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path).toDF(*names))


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """An object with an array ``value`` gives its records, a list its rows, else one row.

    Only a file that is one object can be such a wrapper: neither the records of a list nor, with
    ``multiline=False``, those of a file of lines are taken apart.
    """
    reader = spark.read.option("multiLine", multiline)
    df = reader.schema(schema).json(path) if schema is not None else reader.json(path)
    value = dict((f.name, f.dataType) for f in df.schema.fields).get("value")
    if isinstance(value, T.ArrayType) and multiline and _is_object(spark, path):
        df = df.select(F.explode("value").alias("_record"))
        df = df.select("_record.*") if isinstance(value.elementType, T.StructType) \
            else df.withColumnRenamed("_record", "value")
    return flatten(df)


def _is_object(spark: SparkSession, path: str) -> bool:
    """Whether the first character that is not blank opens an object."""
    lines = spark.read.text(path)
    start = lines.where(F.trim("value") != "").limit(1).first()
    return start is not None and start["value"].lstrip("\ufeff \t").startswith("{")


def parse_json_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a column of JSON text by its fields, nested ones as ``a.b``."""
    rest = [F.col(quoted(c)) for c in df.columns if c != column]
    return flatten(df.select(*rest, F.from_json(column, schema).alias(column)))


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs become columns named by their dotted path."""
    def leaves(prefix: str, at: str, t: T.StructType) -> list[Column]:
        out = []
        for f in t.fields:
            path, name = f"{at}{quoted(f.name)}", f"{prefix}{f.name}"
            if isinstance(f.dataType, T.StructType):
                out += leaves(name + ".", path + ".", f.dataType)
            else:
                out.append(F.col(path).alias(name))
        return out

    return df.select(*leaves("", "", df.schema))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """One stage table, NaN as null."""
    return nan_to_null(spark.read.parquet(path))


def scan_tree(
    spark: SparkSession, root: str, pattern: str = "*", fmt: str = "parquet",
    schema: T.StructType | str | None = None, **options,
) -> DataFrame:
    """All files under ``root`` as one table with ``table_name`` (``parent__stem``).

    Files of skipped kinds and folders are left out; a file right under the
    root is named by its stem alone.
    """
    reader = spark.read.format(fmt).options(
        recursiveFileLookup=True, pathGlobFilter=pattern, **options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(root)
    path = F.col("_metadata.file_path")
    keep = F.lit(True)
    for s in SKIPPED_SUFFIXES:
        keep = keep & ~path.endswith(s)
    for folder in SKIPPED_FOLDERS:
        keep = keep & ~path.contains(folder)
    # Below the root; the scheme and a doubled slash before it may differ from what was asked for.
    top = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    start = F.locate(f"/{top}/", path) + len(top) + 2
    below = F.split(F.substring(path, start, F.length(path)), "/")
    stem = F.regexp_replace(F.element_at(below, -1), r"\.[^.]*$", "")
    name = F.when(F.size(below) == 1, stem).otherwise(
        F.concat(F.try_element_at(below, F.lit(-2)), F.lit("__"), stem))
    return df.where(keep).select("*", name.alias("table_name"))
