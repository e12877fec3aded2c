"""A1-A3 kept up from changes: signed deltas merged into stored sums.

A keyed upsert tells which rows came (+1) and which went (-1).  Their signed
sums, per group, are added to the stored ones: a drop of new and replaced
rows costs what it changes, not what the table holds.  A maximum cannot be
taken back, so it is read anew, for the groups alone that lost a row with
their stored maximum.

Sums are decimals: what was added can be taken away exactly, in any order.
The state is a versioned table whose pointer names the source version it
stands for.  A run that dies leaves the older state and is repeated from
there: no change is applied twice or missed.  Where the changes are no longer
kept, or none were, the state is built from the table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.functions.casts import col_or_null
from barrio.functions.keys import norm_key
from barrio.operators.unify import unified_model
from barrio.sources import versioned
from barrio.sources.versioned import SIGN

ROWS = "_rows"
SOURCE = "source_version"
EXACT = "decimal(28,10)"
EPOCH = "1970-01-01"


@dataclass(frozen=True)
class Spec:
    """A maintained aggregate: ``prepare`` maps source rows (and their sign) to
    group keys and measures; sums skip nulls, as ``sum`` does."""

    keys: Sequence[str]
    prepare: Callable[[DataFrame], DataFrame]
    sums: Sequence[str]
    maxima: Sequence[str] = field(default_factory=tuple)


def _signed(rows: DataFrame, spec: Spec) -> DataFrame:
    """One row per group: signed sums, and the largest values that came and went."""
    s = F.col(SIGN)
    return spec.prepare(rows).groupBy(*spec.keys).agg(
        F.sum(s).cast("bigint").alias(ROWS),
        *[F.coalesce(F.sum(F.col(c) * s), F.lit(0)).alias(c) for c in spec.sums],
        *[F.max(F.when(s > 0, F.col(c))).alias(f"_came_{c}") for c in spec.maxima],
        *[F.max(F.when(s < 0, F.col(c))).alias(f"_gone_{c}") for c in spec.maxima])


def build(table: DataFrame, spec: Spec) -> DataFrame:
    """The state of a whole table: keys, _rows, sums, maxima."""
    g = _signed(table.withColumn(SIGN, F.lit(1)), spec)
    return g.select(*spec.keys, ROWS, *spec.sums, *[F.col(f"_came_{c}").alias(c) for c in spec.maxima])


def _same(keys: Sequence[str], a: str, b: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def apply_changes(state: DataFrame, changes: DataFrame, table: DataFrame, spec: Spec) -> DataFrame:
    """The state after signed ``changes``; ``table`` holds the rows after them."""
    delta = _signed(changes, spec).checkpoint(eager=True)
    both = state.alias("s").join(delta.alias("d"), _same(spec.keys, "s", "d"), "full_outer")
    keys = [F.coalesce(f"s.{k}", f"d.{k}").alias(k) for k in spec.keys]
    zero = F.lit(0)
    moved = both.select(
        *keys, (F.coalesce(f"s.{ROWS}", zero) + F.coalesce(f"d.{ROWS}", zero)).cast("bigint").alias(ROWS),
        *[(F.coalesce(f"s.{c}", zero) + F.coalesce(f"d.{c}", zero)).cast(state.schema[c].dataType).alias(c)
          for c in spec.sums],
        *[F.greatest(f"s.{c}", f"d._came_{c}").alias(c) for c in spec.maxima],
        *[F.coalesce(F.col(f"d._gone_{c}") >= F.col(f"s.{c}"), F.lit(False)).alias(f"_stale_{c}") for c in spec.maxima])
    moved = moved.where(F.col(ROWS) > 0)
    if not spec.maxima:
        return moved
    stale = moved.where(" OR ".join(f"_stale_{c}" for c in spec.maxima)).select(*spec.keys).checkpoint(eager=True)
    out = moved.select(*spec.keys, ROWS, *spec.sums, *spec.maxima)
    if stale.isEmpty():
        return out
    left = spec.prepare(table.withColumn(SIGN, F.lit(1))).alias("t").join(
        stale.alias("k"), _same(spec.keys, "t", "k"), "left_semi")
    anew = left.groupBy(*spec.keys).agg(*[F.max(c).alias(c) for c in spec.maxima]).withColumn("_anew", F.lit(True))
    return out.alias("o").join(anew.alias("n"), _same(spec.keys, "o", "n"), "left").select(
        *[f"o.{c}" for c in (*spec.keys, ROWS, *spec.sums)],
        *[F.when(F.col("n._anew"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in spec.maxima])


def maintain(spark: SparkSession, source: str, state: str, spec: Spec) -> DataFrame:
    """Bring the state at ``state`` up to the newest version of ``source``."""
    now = versioned.current(spark, source)
    had = versioned.current(spark, state)
    done = had.properties[SOURCE] if had else 0
    if had and done == now.number:
        return versioned.read_table(spark, state)
    changes = versioned.read_changes(spark, source, done) if had else None
    table = versioned.read_table(spark, source, now.number)
    new = build(table, spec) if changes is None else apply_changes(
        versioned.read_table(spark, state), changes, table, spec)
    versioned.replace_table(new, state, properties={SOURCE: now.number})
    return versioned.read_table(spark, state)

# ------------------------------------------------------------- A1, A2 and A3


def price_rows(prices: DataFrame) -> DataFrame:
    price = F.col("price_per_meter").try_cast("double")
    return prices.select(norm_key(F.col("neighborhood_name")).alias("join_neigh"),
                         F.col("year").try_cast("int").alias("year"), price.cast(EXACT).alias("price_sum"),
                         price.isNotNull().cast("bigint").alias("price_n"), SIGN)


PRICES = Spec(("join_neigh", "year"), price_rows, ("price_sum", "price_n"))


def price_means(state: DataFrame) -> DataFrame:
    """A1 from its state."""
    return state.select("join_neigh", "year", F.try_divide(F.col("price_sum").cast("double"), F.col("price_n"))
                        .alias("average_price_per_square_meter"))


def incident_rows(accidents: DataFrame) -> DataFrame:
    def known(name: str) -> Column:
        return F.coalesce(col_or_null(accidents, name, "bigint"), F.lit(0).cast("bigint"))

    return accidents.select(
        norm_key(col_or_null(accidents, "neighborhood_name", "string")).alias("join_neigh"),
        col_or_null(accidents, "year", "int").alias("year"),
        col_or_null(accidents, "neighborhood_id", "int").alias("neighborhood_code"),
        known("num_victims").alias("victims"),
        col_or_null(accidents, "num_victims", "bigint").isNotNull().cast("bigint").alias("victims_n"),
        known("num_deaths").alias("deaths"), known("num_minor_injuries").alias("minor"),
        known("num_serious_injuries").alias("serious"), SIGN)


INCIDENTS = Spec(("join_neigh", "year"), incident_rows, ("victims", "victims_n", "deaths", "minor", "serious"),
                 ("neighborhood_code",))


def incident_sums(state: DataFrame) -> DataFrame:
    """A2 from its state."""
    return state.select(
        "join_neigh", "year", "neighborhood_code", F.col(ROWS).alias("number_of_accidents"),
        F.when(F.col("victims_n") > 0, F.col("victims")).alias("number_accident_victims"),
        F.col("deaths").alias("accident_deaths"), F.col("minor").alias("number_injured_lleus"),
        F.col("serious").alias("number_injured_greu"))


def site_rows(sites: DataFrame) -> DataFrame:
    day = F.datediff(col_or_null(sites, "created").try_cast("date"), F.lit(EPOCH).cast("date")).cast("bigint")
    return sites.select(norm_key(col_or_null(sites, "neighborhood_name", "string")).alias("join_neigh"),
                        F.coalesce(day, F.lit(0).cast("bigint")).alias("days"),
                        day.isNotNull().cast("bigint").alias("dated"), SIGN)


SITES = Spec(("join_neigh",), site_rows, ("days", "dated"))


def site_means(state: DataFrame, as_of: str | dt.date, skip_missing_dates: bool = False) -> DataFrame:
    """A3 from its state, which holds days: any date will do to count from."""
    today = F.datediff(F.lit(str(as_of)).cast("date"), F.lit(EPOCH).cast("date"))
    age = (F.col("dated") * today - F.col("days")) / F.lit(365)
    return state.select("join_neigh", F.col(ROWS).alias("number_of_cultural_sites"),
                        F.try_divide(age, F.col("dated" if skip_missing_dates else ROWS))
                        .alias("average_antiquity_cultural_sites"))


def unified_from_states(prices: DataFrame, incidents: DataFrame, sites: DataFrame, as_of: str | dt.date) -> DataFrame:
    """J-3 over the three states."""
    return unified_model(price_means(prices), incident_sums(incidents), site_means(sites, as_of))
