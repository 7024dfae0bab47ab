"""Randomness that depends on the row alone, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U32 = 4294967296


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def u32(*parts) -> Column:
    """First 32 bits of sha1 over the parts joined with ':'."""
    text = F.concat_ws(":", *[as_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.sha1(text), 1, 8), 16, 10).cast("long")


def unit(*parts) -> Column:
    """Uniform draw in [0, 1)."""
    return u32(*parts) / F.lit(float(U32))


def hash_split(seed, ident, ratio: float) -> Column:
    """True for held-out rows."""
    if not 0.0 <= ratio <= 1.0:
        raise ValueError(f"ratio must lie in [0, 1]: {ratio}")
    return u32(seed, ident) < F.lit(int(ratio * U32))
