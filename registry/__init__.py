"""Registered queries: each operator bound to the given tables, with its SQL check."""

from registry.base import ORACLES, QUERIES
from registry import (  # noqa: F401
    cleaning, columns, combining, features, models, privacy, profiling, reports, series, sources,
)
