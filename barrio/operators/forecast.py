"""Trends of yearly series and projection to a target year.

Series live inside each document as ``info: array<struct<year, ...>>``
(bounded by the number of years), so every operator here is a per-row
higher-order-function expression: no shuffle, no Python, and each document
projects independently of all others.  "Consecutive" means array order,
as in the source, not year order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from barrio.functions.noise import jitter, py_round, uniform

# Projected metrics, secondary metrics (and the primary they
# derive from), noise levels and the chance cut of the source generator.
SERIES_METRICS = ("Amount", "usedAmount", "PerMeter", "usedPerMeter")
SECONDARY_METRICS = (("diffAmount", "Amount"), ("diffPerMeter", "PerMeter"))
DEFAULT_END_YEAR = 2025
DEFAULT_VARIANCE = 0.15
SECONDARY_VARIANCE = 0.2
SECONDARY_FACTOR = 1.1
SECONDARY_THRESHOLD = 0.3        # secondary metrics present when u > 0.3

ENTRY_FIELDS = ("year",) + SERIES_METRICS + tuple(s for s, _ in SECONDARY_METRICS)


def _fields(df: DataFrame, info: str) -> set[str]:
    t = df.schema[info].dataType
    if isinstance(t, ArrayType) and isinstance(t.elementType, StructType):
        return set(t.elementType.fieldNames())
    return set()


def normalized_history(df: DataFrame, info: str = "info") -> Column:
    """The history as ``array<struct<year int, metrics double...>>``."""
    have = _fields(df, info)

    def entry(e):
        cols = [e["year"].try_cast("int").alias("year")]
        for f in ENTRY_FIELDS[1:]:
            v = e[f].try_cast("double") if f in have else F.lit(None).cast("double")
            cols.append(v.alias(f))
        return F.struct(*cols)

    return F.transform(F.col(info), entry)


def _size(history: Column) -> Column:
    """Entries in the history; 0 for null (size(null) is -1 with ANSI off)."""
    return F.when(history.isNull(), F.lit(0)).otherwise(F.size(history))


def trend(history: Column, field: str) -> Column:
    """Mean of consecutive differences (missing values count as 0.0);
    0.0 with fewer than two entries.

    The differences telescope, so the mean is ``(last - first) / (n - 1)``:
    O(1) per row, and one rounding step instead of n.
    """
    n = _size(history)
    first = F.coalesce(F.try_element_at(history, F.lit(1))[field], F.lit(0.0))
    last = F.coalesce(F.try_element_at(history, F.lit(-1))[field], F.lit(0.0))
    return F.when(n >= 2, (last - first) / (n - 1)).otherwise(F.lit(0.0))


def last_entry(history: Column) -> Column:
    """The last element (null for an empty or null history)."""
    return F.try_element_at(history, F.lit(-1))


def _prepared(docs: DataFrame, key: str, info: str) -> DataFrame:
    """History, last entry and trends as plain columns, computed once per row,
    so the per-year lambda below only reads fields."""
    hist = docs.withColumn("_hist", normalized_history(docs, info))
    h = F.col("_hist")
    return hist.select("*", last_entry(h).alias("_last"), F.col(key).cast("string").alias("_key"),
                       *[trend(h, m).alias(f"_t_{m}") for m in SERIES_METRICS])


def projection(end_year: int = DEFAULT_END_YEAR, variance: float = DEFAULT_VARIANCE, seed: int = 42,
               secondary_threshold: float = SECONDARY_THRESHOLD) -> Column:
    """The entries for ``last year + 1 .. end_year`` (over the columns
    of ``_prepared``).

    Each year: ``v = round(prev + trend + noise, 1)``, stored as
    ``max(0, v)``, and the next year starts from the stored value.  Secondary
    metrics appear when ``u > secondary_threshold`` and derive from the
    unclamped primary.  Noise ``u`` hashes (key, year, metric, seed), so a
    rerun -- or a recomputed partition -- gives the same numbers.
    ``variance=0`` and ``secondary_threshold=1`` give the deterministic form.
    """
    last = F.col("_last")
    key = F.col("_key")
    last_year = last["year"]
    years = F.when(last_year.isNotNull() & (F.lit(end_year) > last_year),
                   F.sequence(last_year + 1, F.lit(end_year))) \
             .otherwise(F.array().cast("array<int>"))
    template = F.struct(F.lit(None).cast("int").alias("year"),
                        *[F.lit(None).cast("double").alias(f) for f in ENTRY_FIELDS[1:]])
    empty = F.filter(F.array(template), lambda e: F.lit(False))
    start = F.struct(*[F.coalesce(last[m], F.lit(0.0)).alias(m) for m in SERIES_METRICS],
                     empty.alias("out"))

    def u(y: Column, tag: str) -> Column:
        return uniform(key, y, F.lit(tag), seed=seed)

    def step(acc: Column, y: Column) -> Column:
        noisy = {m: jitter(acc[m] + F.col(f"_t_{m}"), variance, u(y, m)) for m in SERIES_METRICS}
        keep = u(y, "secondary") > F.lit(float(secondary_threshold))
        entry = F.struct(
            y.alias("year"),
            *[F.greatest(F.lit(0.0), noisy[m]).alias(m) for m in SERIES_METRICS],
            *[F.when(keep, py_round(jitter(noisy[p] * F.lit(SECONDARY_FACTOR), SECONDARY_VARIANCE,
                                           u(y, s)), 1)).alias(s)
              for s, p in SECONDARY_METRICS])
        return F.struct(*[entry[m].alias(m) for m in SERIES_METRICS],
                        F.concat(acc["out"], F.array(entry)).alias("out"))

    return F.aggregate(years, start, step, lambda acc: acc["out"])


def extend_history(docs: DataFrame, end_year: int = DEFAULT_END_YEAR, key: str = "_id",
                   info: str = "info", variance: float = DEFAULT_VARIANCE, seed: int = 42,
                   secondary_threshold: float = SECONDARY_THRESHOLD) -> DataFrame:
    """Each document's history followed by its projected years."""
    p = _prepared(docs, key, info)
    proj = projection(end_year, variance, seed, secondary_threshold)
    return p.withColumn(info, F.concat(F.col("_hist"), proj)).select(*docs.columns)


def projected_rows(docs: DataFrame, end_year: int = DEFAULT_END_YEAR, key: str = "_id",
                   info: str = "info", variance: float = DEFAULT_VARIANCE, seed: int = 42,
                   secondary_threshold: float = SECONDARY_THRESHOLD) -> DataFrame:
    """Only the projected entries, one row per (key, year)."""
    p = _prepared(docs, key, info)
    proj = projection(end_year, variance, seed, secondary_threshold)
    return p.select(F.col(key), F.explode(proj).alias("_p")).select(key, "_p.*")


def series_trends(docs: DataFrame, key: str = "_id", info: str = "info") -> DataFrame:
    """One row per document with its history length and four trends."""
    hist = normalized_history(docs, info)
    return docs.select(F.col(key), _size(hist).alias("n_years"),
                       *[trend(hist, m).alias(f"trend_{m}") for m in SERIES_METRICS])
