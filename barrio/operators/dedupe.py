"""One row per key with a defined winner, skew-safe.

``dropDuplicates`` keeps an arbitrary row, and a ``row_number`` window puts
every row of a key into one task.  Here the winner is chosen by a ``min``
(or ``max``) aggregate over a struct of ordering fields and the other
columns: Spark combines it map-side, so a key holding a third of the
data is reduced inside each input task before anything is shuffled.

Nulls lose in both directions, matching ``ORDER BY ... NULLS LAST`` in SQL:
they are Spark's smallest values, so for ``min`` each ordering field is
preceded by a null flag.  After the caller's ordering, every remaining
orderable column breaks ties, so the survivor is fully determined by the
data.  The row is read from the fields it was ordered by: each value is
shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DecimalType, IntegralType, MapType, StringType, TimestampNTZType,
                               TimestampType, VariantType)

from barrio.functions.casts import quoted


def _orderable(dtype) -> bool:
    return not isinstance(dtype, (MapType, VariantType))


def _exact(dtype) -> bool:
    """Equal values of the type are the same value (0.0 equals -0.0)."""
    return isinstance(dtype, (BinaryType, BooleanType, DateType, DecimalType, IntegralType, TimestampNTZType,
                              TimestampType)) or dtype == StringType()


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (),
             prefer: str = "min") -> DataFrame:
    """One row per ``keys``: the smallest (``prefer="min"``) or largest row by
    ``order`` then by all other columns; nulls never win.  Null keys form one
    group, as in ``dropDuplicates``."""
    if prefer not in ("min", "max"):
        raise ValueError("prefer must be 'min' or 'max'")
    parts, found = _parts(df, keys, order, prefer == "min")
    pick = F.min if prefer == "min" else F.max
    return (df.groupBy(*[F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys)])
              .agg(pick(F.struct(*parts)).alias("_w"))
              .select(*[F.col(found[c]).alias(c) for c in df.columns]))


def _parts(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], flags: bool,
           whole: str = "_w") -> tuple[list[Column], dict[str, str]]:
    """Fields of a struct that orders rows and holds them, and where in it (or
    in the keys ``_k0``, ``_k1``) each column of ``df`` is found again."""
    found = {c: f"_k{i}" for i, c in enumerate(keys) if c in df.columns and _exact(df.schema[c].dataType)}
    named = {c for c in order if isinstance(c, str)}
    ordering: list[tuple[str | None, Column]] = [(c, F.col(quoted(c))) if isinstance(c, str) else (None, c) for c in order]
    ordering += [(f.name, F.col(quoted(f.name))) for f in df.schema.fields
                 if f.name not in keys and f.name not in named and _orderable(f.dataType)]
    parts = []
    for i, (name, c) in enumerate(ordering):
        parts += [c.isNull().alias(f"_n{i}")] * flags + [c.alias(f"_v{i}")]
        if name in df.columns:
            found.setdefault(name, f"{whole}._v{i}")
    for i, c in enumerate(c for c in df.columns if c not in found):
        parts.append(F.col(quoted(c)).alias(f"_o{i}"))
        found[c] = f"{whole}._o{i}"
    return parts, found


def latest(df: DataFrame, keys: Sequence[str], version: Sequence[Column | str]) -> DataFrame:
    """Last-write-wins: the row with the greatest ``version`` per key."""
    return keep_one(df, keys, version, prefer="max")


def latest_and_held(df: DataFrame, keys: Sequence[str], version: Sequence[Column | str], held: str) -> DataFrame:
    """``latest`` of ``df``, with what each key held before, in one aggregate:
    ``_new``, ``_moved`` (the key held no row or another one), ``_old`` (of keys
    that moved, a row where ``held`` is true; null if there is none) and
    ``_held`` (how many such rows there are)."""
    columns = [c for c in df.columns if c != held]
    parts, found = _parts(df.select(*map(quoted, columns)), keys, version, False)
    row = F.struct(*parts)

    def back(w: str) -> Column:
        return F.struct(*[F.col(found[c].replace("_w.", f"{w}.", 1)).alias(c) for c in columns])

    return (df.groupBy(*[F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys)])
              .agg(F.max(F.when(~F.col(held), row)).alias("_a"), F.max(F.when(F.col(held), row)).alias("_b"),
                   F.count(F.when(F.col(held), True)).alias("_held"))
              .withColumn("_w", F.greatest("_a", "_b"))
              .select(back("_w").alias("_new"), F.when(F.col("_held") > 0, back("_b")).alias("_old"), "_held")
              .withColumn("_moved", ~F.col("_new").eqNullSafe(F.col("_old")))
              .withColumn("_old", F.when(F.col("_moved"), F.col("_old"))))
