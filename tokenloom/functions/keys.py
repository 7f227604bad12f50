"""Deterministic pseudo-random keys: the same for every engine, partitioning and retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_RANGE = float(16**15)


def order_key(seed: int, *parts: Column) -> Column:
    """md5 of `seed:part:part...`, uniform over its hexadecimal strings."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def key_integer(key: Column) -> Column:
    """The first 60 bits of an order key."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("long")


def uniform(key: Column) -> Column:
    """A number in [0, 1)."""
    return key_integer(key) / F.lit(KEY_RANGE)
