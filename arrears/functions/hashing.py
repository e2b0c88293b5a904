"""Randomness taken from row keys.

A draw depends on the seed and the key only, so it is the same for every
partitioning, retry and engine. Keys must identify rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_DIGITS = 13  # 52 bits: every value is an exact double


def digest(seed: object, *keys: Column | str) -> Column:
    """128 random bits as a hexadecimal text: ``md5('seed:key[:key..]')``."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def unit(hex_text: Column) -> Column:
    """Uniform double in [0, 1)."""
    return F.conv(F.substring(hex_text, 1, UNIT_DIGITS), 16, 10).cast("double") / F.lit(
        float(16**UNIT_DIGITS)
    )


def position(hex_text: Column, size: Column) -> Column:
    """Uniform integer in [0, size)."""
    return F.conv(F.substring(hex_text, 1, 15), 16, 10).cast("bigint") % size


def share_limit(share: float) -> str:
    """Text bound below which a digest falls with probability ``share``."""
    if not 0.0 <= share <= 1.0:
        raise ValueError("share must lie between 0 and 1")
    if share == 1.0:
        return "g"  # above every hexadecimal text
    return format(int(share * 16**UNIT_DIGITS), f"0{UNIT_DIGITS}x")


def falls_below(hex_text: Column, share: float) -> Column:
    return hex_text < F.lit(share_limit(share))
