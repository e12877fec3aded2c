"""Repeatable pseudo-random numbers and the projection noise.

``uniform`` hashes its arguments, so a value depends only on the row's own
fields and the seed -- never on partitioning or task order, which keeps
reruns after executor loss identical.  The hash is the first 32 bits of
``md5("a|b|...|seed")``: built into Spark and into SQL engines alike, so
the same numbers can be recomputed by an independent oracle.  Hash
integers and strings (doubles print differently across engines).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def hash32(*cols: Column, seed: int = 42) -> Column:
    """Unsigned 32-bit hash of the values (as text) and the seed."""
    text = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(*cols: Column, seed: int = 42) -> Column:
    """A value in [0, 1) derived from ``cols`` and ``seed``."""
    return hash32(*cols, seed=seed) / F.lit(TWO_32)


def py_round(c: Column, digits: int = 1) -> Column:
    """Half-to-even rounding, the closest built-in to Python's ``round``."""
    return F.bround(c, digits)


def jitter(value: Column, variance: float | Column, u: Column) -> Column:
    """``round(v + v * variance * (u - 0.5), 1)``: noise of +-variance/2."""
    var = variance if isinstance(variance, Column) else F.lit(float(variance))
    return py_round(value + value * var * (u - F.lit(0.5)), 1)
