"""Area x year aggregates (prices, incidents, sites) and mergeable partials.

Each aggregate has a *partial* form (any grain) and a *merge* form (coarser
grain).  Row-level callers use the one-step functions; plans that must join
a dimension before they know the area pre-aggregate at the entity grain
first, so a hot entity collapses map-side before any shuffle and the join
moves one row per (entity, year) instead of every fact row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barrio.functions.casts import col_or_null
from barrio.functions.dates import antiquity_years
from barrio.functions.keys import norm_key

KEYS = ("join_neigh", "year")

# ---------------------------------------------------------------- A1 prices

def mean_partial(df: DataFrame, keys: Sequence[str | Column], value: str | Column) -> DataFrame:
    """(keys, _sum, _n): a mergeable mean state; nulls are skipped like ``avg``."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.sum(v).alias("_sum"), F.count(v).alias("_n"))


def mean_merge(partials: DataFrame, keys: Sequence[str | Column], out: str) -> DataFrame:
    """Finish mean states at a coarser grain (null when every value was null)."""
    return partials.groupBy(*keys).agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias(out))


def avg_price(prices: DataFrame, area: str = "neighborhood_name", year: str = "year",
              value: str = "price_per_meter") -> DataFrame:
    """A1: mean price per (normalized area, year); a null key is its own group."""
    keyed = prices.select(norm_key(F.col(area)).alias("join_neigh"),
                          F.col(year).try_cast("int").alias("year"),
                          F.col(value).try_cast("double").alias("_v"))
    return keyed.groupBy(*KEYS).agg(F.avg("_v").alias("average_price_per_square_meter"))

# ------------------------------------------------------------- A2 incidents

def incident_columns(df: DataFrame) -> DataFrame:
    """Canonical incident columns; any missing one becomes a typed null."""
    return df.select(
        norm_key(col_or_null(df, "neighborhood_name", "string")).alias("join_neigh"),
        col_or_null(df, "year", "int").alias("year"),
        col_or_null(df, "neighborhood_id", "int").alias("neighborhood_code"),
        col_or_null(df, "num_victims", "bigint").alias("num_victims"),
        col_or_null(df, "num_deaths", "bigint").alias("num_deaths"),
        col_or_null(df, "num_minor_injuries", "bigint").alias("num_minor_injuries"),
        col_or_null(df, "num_serious_injuries", "bigint").alias("num_serious_injuries"),
    )


def incident_partial(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """A2 at any grain over canonical incident columns.

    ``number_accident_victims`` stays null when every victim count is null
    (zero-filled only in the unified model); the three injury sums treat a
    missing count as 0.
    """
    zero = F.lit(0).cast("bigint")
    return df.groupBy(*keys).agg(
        F.max("neighborhood_code").alias("neighborhood_code"),
        F.count(F.lit(1)).alias("number_of_accidents"),
        F.sum("num_victims").alias("number_accident_victims"),
        F.sum(F.coalesce("num_deaths", zero)).alias("accident_deaths"),
        F.sum(F.coalesce("num_minor_injuries", zero)).alias("number_injured_lleus"),
        F.sum(F.coalesce("num_serious_injuries", zero)).alias("number_injured_greu"),
    )


def incident_merge(partials: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Merge ``incident_partial`` rows to a coarser grain (same columns)."""
    return partials.groupBy(*keys).agg(
        F.max("neighborhood_code").alias("neighborhood_code"),
        F.sum("number_of_accidents").alias("number_of_accidents"),
        F.sum("number_accident_victims").alias("number_accident_victims"),
        F.sum("accident_deaths").alias("accident_deaths"),
        F.sum("number_injured_lleus").alias("number_injured_lleus"),
        F.sum("number_injured_greu").alias("number_injured_greu"),
    )


def incident_totals(accidents: DataFrame) -> DataFrame:
    """A2: incident totals per (normalized area, year)."""
    return incident_partial(incident_columns(accidents), KEYS)

# ----------------------------------------------------------------- A3 sites

def site_totals(sites: DataFrame, as_of: str | dt.date, skip_missing_dates: bool = False) -> DataFrame:
    """A3: site count and mean antiquity (years) per normalized area.

    The area comes from ``addresses_neighborhood_name`` when that column
    exists, else ``neighborhood_name``.  A site without a usable ``created``
    date counts as antiquity 0 (the source behaviour); pass
    ``skip_missing_dates=True`` to average known dates only.
    """
    area = ("addresses_neighborhood_name" if "addresses_neighborhood_name" in sites.columns
            else "neighborhood_name")
    age = antiquity_years(F.col("created"), as_of) if "created" in sites.columns else F.lit(0.0)
    keyed = sites.select(norm_key(col_or_null(sites, area, "string")).alias("join_neigh"),
                         age.alias("_age"))
    mean_age = F.avg("_age") if skip_missing_dates else F.avg(F.coalesce("_age", F.lit(0.0)))
    return keyed.groupBy("join_neigh").agg(
        F.count(F.lit(1)).alias("number_of_cultural_sites"),
        mean_age.alias("average_antiquity_cultural_sites"),
    )

# ---------------------------------------------------------------- A4 max

def max_per_group(df: DataFrame, keys: Sequence[str | Column], value: str, out: str = "last_year") -> DataFrame:
    """A4: maximum of ``value`` per group (partial aggregation, one shuffle)."""
    return df.groupBy(*keys).agg(F.max(value).alias(out))
