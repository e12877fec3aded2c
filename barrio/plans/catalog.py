"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (or data
Spark derives from them) and returns a lazy DataFrame.  Float outputs are
rounded to 4 places on both sides so engine-specific summation order does
not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating-point column (report form for the oracle check)."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def load_all() -> None:
    """Import every module that registers queries."""
    from barrio.plans import (queries_core, queries_format, queries_model,  # noqa: F401
                              queries_repair, queries_sources, queries_validation,
                              queries_zones)
