"""A5, M1: class cuts from mergeable quantile sketches.

One KLL sketch per group (a year, a landing drop) is stored as binary of
bounded size.  Cuts of any set of groups come from merging their sketches: a
new year is sketched once and older rows are never read again.  A cut's rank
is off by at most ``rank_error(k)`` of the rows (with 99 % confidence).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.operators.label import CLASS_PROBABILITIES

K = 400
SKETCH, N = "_sketch", "_n"


def rank_error(k: int = K) -> float:
    """Published error of a KLL sketch's ranks, as a share of the rows."""
    return 2.296 / k ** 0.9723


def sketches(df: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """(by, _sketch, _n): one sketch a group, built map-side; nulls are skipped."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(*by).agg(
        F.kll_sketch_agg_double(v, F.lit(k)).alias(SKETCH), F.count(v).alias(N))


def merged(stored: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """Sketches of coarser groups (or of everything) from stored ones."""
    return stored.groupBy(*by).agg(F.kll_merge_agg_double(SKETCH, F.lit(k)).alias(SKETCH), F.sum(N).alias(N))


def sketch_cuts(stored: DataFrame, probs: Sequence[float] = CLASS_PROBABILITIES, k: int = K) -> list[float]:
    """Cut points of all rows the sketches stand for: two numbers on the driver."""
    row = merged(stored, k=k).where(F.col(N) > 0).select(
        *[F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))) for p in probs]).first()
    if row is None:
        raise ValueError("no values: cannot place class cuts")
    return list(row)
