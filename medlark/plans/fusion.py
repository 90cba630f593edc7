"""Cleaned tables to feature tables per domain and one combined table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medlark.functions.storage import cut_lineage
from medlark.operators.combine import DOMAINS, fuse_domain, zip_samples
from medlark.operators.features import Reduced, engineer_features, reduce_features
from medlark.plans.batch import each_table


def fuse(tables: dict[str, DataFrame], domains: dict[str, list[str]] = DOMAINS,
         **options) -> dict[str, Reduced]:
    """Stack, engineer and reduce each domain. The engineered table is stored once."""
    stacked, _, _ = fuse_domain(tables, domains)
    return {d: reduce_features(cut_lineage(engineer_features(t)), **options)
            for d, t in stacked.items()}


def combine(fused: dict[str, DataFrame], keys: dict[str, list[str]], n: int | None = None) -> DataFrame:
    """Samples of the domains side by side, each with its own name prefix.

    All have the size of the smallest domain, or ``n`` if given and less.
    """
    return zip_samples(fused, keys, n)


def fuse_to(spark: SparkSession, tables: dict[str, DataFrame], out: str, run: str,
            domains: dict[str, list[str]] = DOMAINS, **options) -> dict[str, str]:
    """Write every domain to ``out/<domain>_fused`` and log one audit row each."""
    stacked, _, _ = fuse_domain(tables, domains)
    return each_table(
        spark, stacked, out, run, "_fused",
        lambda t: reduce_features(cut_lineage(engineer_features(t)), **options).table)
