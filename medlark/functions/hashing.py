"""Randomness as a keyed hash of a stable row key.

A retried task, another partitioning or another engine gets the same draw,
which ``rand(seed)`` cannot promise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyed_uniform(*keys: str | Column, salt: str) -> Column:
    """Uniform draw in (0, 1): the first 52 bits of SHA-256(salt|length:key|...).

    Keys go in with their lengths and a null as ``-``, so no two key tuples make one text.
    """
    parts = [_col(k).cast("string") for k in keys]
    text = F.concat_ws("|", F.lit(salt), *[
        F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def keyed_laplace(*keys: str | Column, salt: str, scale: float) -> Column:
    """Laplace(0, scale) by inverse CDF of the keyed uniform."""
    v = keyed_uniform(*keys, salt=salt) - F.lit(0.5)
    return F.lit(-float(scale)) * F.signum(v) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(v))


def short_digest(c: str | Column, length: int = 16, salt: str = "") -> Column:
    """First ``length`` hex digits of SHA-256 of the value as text."""
    text = _col(c).cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.substring(F.sha2(text, 256), 1, length)
