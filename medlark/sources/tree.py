"""A folder of files of mixed kinds as tables: listed, looked into once, grouped by how they are to be read.

The listing is a table of its own. One pass over the text files tells each one's first line and whether all its lines are
UTF-8; files of one separator, encoding and header share a reader, whose types are inferred once.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlark.functions.types import nan_to_null
from medlark.sources.readers import SKIPPED_FOLDERS, sniff_separator, read_json_records

#: How files are read, by suffix; others are left out.
KINDS = {"csv": "delimited", "tsv": "delimited", "txt": "delimited", "data": "headerless", "json": "json", "parquet": "parquet"}


class Found(NamedTuple):
    """One file: the table it belongs to and how to read it."""

    path: str
    table: str
    kind: str
    sep: str | None
    encoding: str | None
    header: str | None


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, table_name, kind) of the files below ``root`` that can be read.

    A table is named ``parent__stem``, a file right under the root by its stem. Parts that a job
    wrote are one table, named by their folder. Folders and files that begin with ``_`` or ``.`` are no tables.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size"))
    top = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    start = F.locate(f"/{top}/", F.col("path")) + len(top) + 2
    below = F.split(F.substring(F.col("path"), start, F.length("path")), "/")
    file = F.element_at(below, -1)
    stem = F.regexp_replace(file, r"\.[^.]*$", "")
    part = stem.rlike(r"^part-\d+") & (F.size(below) > 1)
    names = F.when(part, F.slice(below, 1, F.size(below) - 1)).otherwise(F.concat(F.slice(below, 1, F.size(below) - 1), F.array(stem)))
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    kept = ~F.exists(below, lambda x: x.isin(*SKIPPED_FOLDERS) | x.startswith("_") | x.startswith("."))
    return files.where(kept).select(
        "path", "size", F.array_join(F.slice(names, F.greatest(F.size(names) - 1, F.lit(1)), 2), "__").alias("table_name"),
        kinds[F.lower(F.regexp_extract(file, r"\.([^.]*)$", 1))].alias("kind")).where(F.col("kind").isNotNull())


def look_into(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, first_line, second_line, lines, foreign) of text files: how many lines there are and how many of them are no UTF-8."""
    # Lines of a file in order: by where their split begins, then as they are read.
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.format("text").load(paths).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("path"), "value", at.alias("at"))
    return lines.groupBy("path").agg(
        F.min_by("value", "at").alias("first_line"), F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.is_valid_utf8("value")).alias("foreign"))


def find_tables(spark: SparkSession, root: str) -> list[Found]:
    """All files with how to read them. The driver holds the listing, as Spark's own reader does."""
    listed = list_files(spark, root).where("size > 0").collect()
    texts = [r["path"] for r in listed if r["kind"] != "parquet"]
    heads = {_bare(r["path"]): r for r in look_into(spark, texts).collect()} if texts else {}
    out = []
    for r in listed:
        head = heads.get(_bare(r["path"]))
        if r["kind"] == "parquet":
            out.append(Found(r["path"], r["table_name"], "parquet", None, None, None))
        elif head is None:
            continue
        elif r["kind"] == "json":
            lines = head["lines"] > 1 and head["first_line"].strip().startswith("{") and head["first_line"].strip().endswith("}")
            out.append(Found(r["path"], r["table_name"], "json lines" if lines else "json", None, None, None))
        else:
            first = head["first_line"].lstrip("﻿")
            delimited = r["kind"] == "delimited"
            sep = sniff_separator(first) if delimited else ","
            header = first if delimited else str(first.count(","))
            out.append(Found(r["path"], r["table_name"], r["kind"], sep, "ISO-8859-1" if head["foreign"] else "UTF-8", header))
    return sorted(out)


def _bare(path: str) -> str:
    """A path without its scheme, however many slashes follow that."""
    return path.split(":", 1)[-1].lstrip("/")


def read_tree(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``{table: frame}`` of a folder of delimited, headerless, JSON and Parquet files.

    Headerless columns are named by their number. JSON is taken as by ``read_json_records``. A table whose files are of
    several kinds, or differ in header, raises ValueError. Empty files are left out.
    """
    groups: dict[tuple, list[Found]] = defaultdict(list)
    tables: dict[str, list[Found]] = defaultdict(list)
    for f in find_tables(spark, root):
        groups[f.kind, f.sep, f.encoding, f.header].append(f)
        tables[f.table].append(f)
    schemas = {}
    for (kind, sep, encoding, header), files in groups.items():
        if kind in ("delimited", "headerless"):
            reader = spark.read.options(header=kind == "delimited", sep=sep, encoding=encoding, inferSchema=True, nanValue="NaN")
            df = reader.csv([f.path for f in files])
            schemas[kind, sep, encoding, header] = df.toDF(*[
                c.lstrip("﻿") if kind == "delimited" else str(i) for i, c in enumerate(df.columns)]).schema
    out = {}
    for name, files in tables.items():
        ways = {(f.kind, f.sep, f.encoding, f.header) for f in files}
        if len(ways) > 1:
            raise ValueError(f"files of {name} differ: {sorted(map(str, ways))}")
        (way,) = ways
        kind, sep, encoding, _ = way
        paths = [f.path for f in files]
        if kind == "parquet":
            out[name] = nan_to_null(spark.read.parquet(*paths))
        elif kind.startswith("json"):
            out[name] = read_json_records(spark, paths if len(paths) > 1 else paths[0], multiline=kind == "json")
        else:
            out[name] = nan_to_null(spark.read.options(
                header=kind == "delimited", sep=sep, encoding=encoding, nanValue="NaN").schema(schemas[way]).csv(paths))
    return out
