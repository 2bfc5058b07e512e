"""Random numbers that depend on a row key only, so reruns and retries agree."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(keys, seed: int) -> Column:
    """Integer in [0, 2**32) from the key columns and a seed."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    text = F.concat_ws(":", *[_col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(keys, seed: int) -> Column:
    """Uniform number in [0, 1) from the key columns and a seed."""
    return hash_u32(keys, seed) / F.lit(4294967296.0)


def randint(keys, seed: int, low: int, high: int) -> Column:
    """Integer in [low, high) from the key columns and a seed."""
    return (F.lit(low) + F.floor(uniform(keys, seed) * F.lit(float(high - low)))).cast("bigint")
