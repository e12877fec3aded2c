"""J-1..J-3: the unified area x year model, and its join-coverage report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIFIED_COLUMNS = (
    "neighborhood_name", "year", "neighborhood_code", "accident_deaths",
    "number_injured_lleus", "number_injured_greu", "number_accident_victims",
    "number_of_accidents", "number_of_cultural_sites",
    "average_antiquity_cultural_sites", "average_price_per_square_meter",
)


def _joined(prices: DataFrame, incidents: DataFrame, sites: DataFrame) -> DataFrame:
    # Both right sides are unique on their keys (they are group-bys), so the
    # row count equals the price groups.  prices and incidents share the
    # (join_neigh, year) hash partitioning from their aggregates; sites is
    # one row per area and AQE turns that join into a broadcast once the
    # aggregate's real size is known (sort-merge beyond the threshold).
    a = incidents.withColumn("_has_a", F.lit(True))
    c = sites.withColumn("_has_c", F.lit(True))
    return (prices.join(a, ["join_neigh", "year"], "left")
                  .join(c, ["join_neigh"], "left"))


def unified_model(prices: DataFrame, incidents: DataFrame, sites: DataFrame,
                  flags: bool = False) -> DataFrame:
    """Price groups LEFT JOIN incidents on (area, year) LEFT JOIN sites on area.

    Missing incident/site data is zero-filled and the code becomes
    ``UNKNOWN``; ``flags=True`` adds ``has_accident_data`` and
    ``has_culture_data`` so "no record" can be told apart from zero.
    """
    j = _joined(prices, incidents, sites)
    zero = F.lit(0).cast("bigint")
    cols = [
        F.col("join_neigh").alias("neighborhood_name"),
        F.col("year"),
        F.coalesce(F.col("neighborhood_code").cast("string"), F.lit("UNKNOWN")).alias("neighborhood_code"),
        F.coalesce("accident_deaths", zero).alias("accident_deaths"),
        F.coalesce("number_injured_lleus", zero).alias("number_injured_lleus"),
        F.coalesce("number_injured_greu", zero).alias("number_injured_greu"),
        F.coalesce("number_accident_victims", zero).alias("number_accident_victims"),
        F.coalesce("number_of_accidents", zero).alias("number_of_accidents"),
        F.coalesce("number_of_cultural_sites", zero).alias("number_of_cultural_sites"),
        F.coalesce("average_antiquity_cultural_sites", F.lit(0.0)).alias("average_antiquity_cultural_sites"),
        F.col("average_price_per_square_meter"),
    ]
    if flags:
        cols += [F.col("_has_a").isNotNull().alias("has_accident_data"),
                 F.col("_has_c").isNotNull().alias("has_culture_data")]
    return j.select(*cols)


def join_coverage(prices: DataFrame, incidents: DataFrame, sites: DataFrame) -> DataFrame:
    """Q4: per join, left rows, matched rows, unmatched rows and unmatched areas.

    Joins are by normalized name, so a spelling difference silently turns
    into zeros; this report makes that visible.  One pass, one tiny agg.
    """
    j = _joined(prices, incidents, sites)
    stats = j.agg(
        F.count(F.lit(1)).alias("left_rows"),
        F.count("_has_a").alias("a_matched"),
        F.count_distinct(F.when(F.col("_has_a").isNull(), F.col("join_neigh"))).alias("a_keys"),
        F.count("_has_c").alias("c_matched"),
        F.count_distinct(F.when(F.col("_has_c").isNull(), F.col("join_neigh"))).alias("c_keys"),
    )
    return stats.select(F.explode(F.array(
        F.struct(F.lit("accidents").alias("join_name"), F.col("left_rows"),
                 F.col("a_matched").alias("matched_rows"),
                 (F.col("left_rows") - F.col("a_matched")).alias("unmatched_rows"),
                 F.col("a_keys").alias("unmatched_areas")),
        F.struct(F.lit("culture").alias("join_name"), F.col("left_rows"),
                 F.col("c_matched").alias("matched_rows"),
                 (F.col("left_rows") - F.col("c_matched")).alias("unmatched_rows"),
                 F.col("c_keys").alias("unmatched_areas")),
    )).alias("r")).select("r.*")
