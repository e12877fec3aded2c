"""Quantile cut points and the 3-class price label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tercile probabilities and default sketch error of the source.
CLASS_PROBABILITIES = (0.33, 0.67)
DEFAULT_RELATIVE_ERROR = 0.01


def quantile_cuts(df: DataFrame, value: str, probs: Sequence[float] = CLASS_PROBABILITIES,
                  relative_error: float = DEFAULT_RELATIVE_ERROR) -> list[float]:
    """Cut points from Spark's distributed quantile sketch (nulls ignored).

    One aggregate job; only the cut points reach the driver.  Use
    ``relative_error=0`` on small, bounded tables for exact ranks.
    """
    cuts = df.approxQuantile(value, list(probs), relative_error)
    if len(cuts) != len(probs):
        raise ValueError(f"no non-null values in {value!r}: cannot place class cuts")
    return cuts


def class_of(value: Column, cuts: Sequence[float]) -> Column:
    """0.0 below the first cut, 1.0 below the second, ... (equal goes up);
    null stays null."""
    expr = None
    for i, c in enumerate(cuts):
        cond = value < F.lit(float(c))
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return F.when(value.isNull(), F.lit(None).cast("double")).otherwise(
        expr.otherwise(F.lit(float(len(cuts)))))


def label_by_quantiles(df: DataFrame, value: str, out: str = "price_category",
                       probs: Sequence[float] = CLASS_PROBABILITIES,
                       relative_error: float = DEFAULT_RELATIVE_ERROR) -> tuple[DataFrame, list[float]]:
    """M1: rows with a value, labelled by quantile class; returns the cuts.

    Rows whose value is null are dropped here (the source code would put
    them in the top class).
    """
    cuts = quantile_cuts(df, value, probs, relative_error)
    return df.filter(F.col(value).isNotNull()).withColumn(out, class_of(F.col(value), cuts)), cuts
