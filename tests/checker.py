"""Compare a registered query with its SQL check on the same tables."""

from __future__ import annotations

import duckdb

from registry.base import COLUMNS

KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in COLUMNS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def differences(spark_df, con, sql: str, limit: int = 5) -> list[str]:
    """Empty if names, types and all rows agree exactly; doubles are compared as text."""
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(spark_df.columns) != sorted(types):
        return [f"columns {sorted(spark_df.columns)} != {sorted(types)}"]
    out = [
        f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in spark_df.schema.fields
        if KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) != types[f.name]
    ]
    con.register("spark_rows", spark_df.toArrow())
    cells = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in sorted(types))
    con.execute(f"CREATE OR REPLACE TEMP TABLE mine AS SELECT {cells} FROM spark_rows")
    con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS SELECT {cells} FROM ({sql})")
    for a, b in (("mine", "theirs"), ("theirs", "mine")):
        extra = con.execute(f"SELECT * FROM (FROM {a} EXCEPT ALL FROM {b}) ORDER BY ALL").fetchall()
        if extra:
            out.append(f"{len(extra)} rows only in {a}, columns {sorted(types)}")
            out += [f"  {r}" for r in extra[:limit]]
    con.unregister("spark_rows")
    return out
