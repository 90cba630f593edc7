"""Run one plan over many tables, with an audit row each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medlark.sources.writers import append_audit, audit_row, write_parquet


def each_table(
    spark: SparkSession, tables: dict[str, DataFrame], out: str, run: str, suffix: str,
    plan: Callable[[DataFrame], DataFrame],
) -> dict[str, str]:
    """Write ``plan(table)`` to ``out/<name><suffix>`` and return the paths.

    An empty table is skipped and a failing one logged; neither stops the rest.
    """
    paths, audit = {}, []
    for name, df in tables.items():
        try:
            if not df.columns or df.limit(1).count() == 0:
                audit.append(dict(run=run, table_name=name, status="skipped", reason="empty"))
                continue
            before = (df.count(), len(df.columns))
            path = f"{out}/{name}{suffix}"
            write_parquet(plan(df), path)
            audit.append(audit_row(spark.read.parquet(path), name, run, before, path=path))
            paths[name] = path
        except Exception as e:  # noqa: BLE001 - one bad table must not stop the run
            audit.append(dict(run=run, table_name=name, status="failed", reason=str(e)))
    append_audit(spark, f"{out}/audit", audit)
    return paths
