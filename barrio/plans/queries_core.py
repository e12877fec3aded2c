"""Core area x year queries: the flagship and its three aggregates."""

from __future__ import annotations

from barrio.plans import area_year as ay
from barrio.plans import sql
from barrio.plans.catalog import query, rounded


@query("unified_area_year", sql.round_cols(sql.UNIFIED, [
        "average_antiquity_cultural_sites", "average_price_per_square_meter"]))
def unified_area_year(spark, d):
    return rounded(ay.unified(spark, d))


@query("avg_price_area_year", sql.round_cols(
        f"SELECT join_neigh AS neighborhood_name, year, average_price_per_square_meter "
        f"FROM ({sql.PRICE_GROUPS}) p", ["average_price_per_square_meter"]))
def avg_price_area_year(spark, d):
    return rounded(ay.price_groups(spark, d).withColumnRenamed("join_neigh", "neighborhood_name"))


@query("incident_totals",
       f"SELECT join_neigh AS neighborhood_name, * EXCLUDE (join_neigh) FROM ({sql.INCIDENT_GROUPS}) a")
def incident_totals(spark, d):
    return ay.incident_groups(spark, d).withColumnRenamed("join_neigh", "neighborhood_name")


@query("site_totals_antiquity", sql.round_cols(
        f"SELECT join_neigh AS neighborhood_name, * EXCLUDE (join_neigh) FROM ({sql.SITE_GROUPS}) c",
        ["average_antiquity_cultural_sites"]))
def site_totals_antiquity(spark, d):
    return rounded(ay.site_groups(spark, d).withColumnRenamed("join_neigh", "neighborhood_name"))


@query("join_coverage", f"""
  WITH p AS ({sql.PRICE_GROUPS}), a AS ({sql.INCIDENT_GROUPS}), c AS ({sql.SITE_GROUPS}),
  j AS (SELECT p.join_neigh, a.join_neigh IS NOT NULL AS ha, c.join_neigh IS NOT NULL AS hc
        FROM p LEFT JOIN a ON p.join_neigh = a.join_neigh AND p.year = a.year
               LEFT JOIN c ON p.join_neigh = c.join_neigh)
  SELECT 'accidents' AS join_name, CAST(count(*) AS BIGINT) AS left_rows,
         CAST(count(*) FILTER (WHERE ha) AS BIGINT) AS matched_rows,
         CAST(count(*) FILTER (WHERE NOT ha) AS BIGINT) AS unmatched_rows,
         CAST(count(DISTINCT join_neigh) FILTER (WHERE NOT ha) AS BIGINT) AS unmatched_areas FROM j
  UNION ALL
  SELECT 'culture', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE hc) AS BIGINT),
         CAST(count(*) FILTER (WHERE NOT hc) AS BIGINT),
         CAST(count(DISTINCT join_neigh) FILTER (WHERE NOT hc) AS BIGINT) FROM j
""")
def join_coverage(spark, d):
    return ay.coverage(spark, d)


@query("unified_with_flags", sql.round_cols(f"""
  WITH p AS ({sql.PRICE_GROUPS}), a AS ({sql.INCIDENT_GROUPS}), c AS ({sql.SITE_GROUPS})
  SELECT p.join_neigh AS neighborhood_name, p.year,
         coalesce(CAST(a.neighborhood_code AS VARCHAR), 'UNKNOWN') AS neighborhood_code,
         coalesce(a.number_of_accidents, 0) AS number_of_accidents,
         coalesce(c.number_of_cultural_sites, 0) AS number_of_cultural_sites,
         p.average_price_per_square_meter,
         a.join_neigh IS NOT NULL AS has_accident_data, c.join_neigh IS NOT NULL AS has_culture_data
  FROM p LEFT JOIN a ON p.join_neigh = a.join_neigh AND p.year = a.year
         LEFT JOIN c ON p.join_neigh = c.join_neigh
""", ["average_price_per_square_meter"]))
def unified_with_flags(spark, d):
    """The unified model with flags telling "no record" from zero."""
    u = ay.unified(spark, d, flags=True)
    return rounded(u.select("neighborhood_name", "year", "neighborhood_code", "number_of_accidents",
                            "number_of_cultural_sites", "average_price_per_square_meter",
                            "has_accident_data", "has_culture_data"))
