"""Schema-tolerant column access.

Raw zones hold files whose columns come and go; a missing column is read as
a typed null, and present ones are ``try_cast`` so bad text becomes null
instead of failing the whole job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Backtick-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def col_or_null(df: DataFrame, name: str, dtype: str | None = None) -> Column:
    """``name`` cast to ``dtype`` when present, else a typed null."""
    if name not in df.columns:
        return typed_null(dtype or "string")
    c = F.col(quoted(name))
    return c.try_cast(dtype) if dtype else c
