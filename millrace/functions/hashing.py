"""Reproducible pseudo-random numbers from keys (never ``rand()``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(seed: object, *keys: Column) -> Column:
    """Unsigned 32-bit number from a seed and key columns: the first 8 hex digits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash01(seed: object, *keys: Column) -> Column:
    """Number in [0, 1) from a seed and key columns."""
    return hash32(seed, *keys) / F.lit(4294967296.0)
