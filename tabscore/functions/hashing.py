"""Reproducible pseudo-random order and fractions from md5 of (seed, key).

The same expressions exist in DuckDB (``md5``, ``concat_ws``, hex parse), so
every sample and split is checkable against the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabscore.functions.text import col


def _key_text(keys: Sequence[str]) -> list[Column]:
    return [col(k).cast("string") for k in keys]


def order_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """md5 hex of ``seed:key1:key2...``; sorting on it is a seeded shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *_key_text(keys)))


def unit_fraction(keys: Sequence[str], seed: int = 42) -> Column:
    """First 32 bits of the md5 as a number in [0, 1)."""
    h = order_hash(keys, seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_bucket(keys: Sequence[str], buckets: int, seed: int = 42) -> Column:
    """Uniform bucket id in [0, buckets) taken from the md5 prefix."""
    return F.floor(unit_fraction(keys, seed) * F.lit(buckets)).cast("int")
