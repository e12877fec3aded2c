"""Shared DuckDB SQL fragments for the oracle queries (mirror area_year)."""


def sround(expr: str, digits: int) -> str:
    """Spark's ``round`` (half up on the value's decimal text): DuckDB's own
    ``round`` scales in binary and can land on a different side of a tie."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def sbround(expr: str, digits: int) -> str:
    """Spark's ``bround`` (half even on the value's decimal text)."""
    return f"CAST(round_even(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"

PRICE_GROUPS = """
  SELECT lower(trim(n.n_name)) AS join_neigh, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         avg(l.l_extendedprice / nullif(l.l_quantity, 0)) AS average_price_per_square_meter
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2
"""

INCIDENT_GROUPS = """
  SELECT lower(trim(n.n_name)) AS join_neigh, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         max(n.n_nationkey) AS neighborhood_code,
         CAST(count(*) AS BIGINT) AS number_of_accidents,
         CAST(sum(CAST(nullif(floor(o.o_totalprice / 100000.0), 0) AS BIGINT)) AS BIGINT) AS number_accident_victims,
         CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS accident_deaths,
         CAST(sum(CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS number_injured_lleus,
         CAST(sum(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS number_injured_greu
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderdate >= TIMESTAMP '1997-01-01'
  GROUP BY 1, 2
"""

SITE_RECORDS = """
  SELECT c.c_custkey AS register_id, n.n_name AS neighborhood_name, f.created
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS created FROM orders GROUP BY 1) f
         ON c.c_custkey = f.o_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_mktsegment = 'BUILDING'
"""

SITE_GROUPS = f"""
  SELECT lower(trim(neighborhood_name)) AS join_neigh,
         CAST(count(*) AS BIGINT) AS number_of_cultural_sites,
         avg(coalesce(date_diff('day', CAST(created AS DATE), DATE '2002-01-01') / 365.0, 0.0))
           AS average_antiquity_cultural_sites
  FROM ({SITE_RECORDS}) s
  GROUP BY 1
"""

UNIFIED = f"""
  WITH p AS ({PRICE_GROUPS}), a AS ({INCIDENT_GROUPS}), c AS ({SITE_GROUPS})
  SELECT p.join_neigh AS neighborhood_name, p.year,
         coalesce(CAST(a.neighborhood_code AS VARCHAR), 'UNKNOWN') AS neighborhood_code,
         coalesce(a.accident_deaths, 0) AS accident_deaths,
         coalesce(a.number_injured_lleus, 0) AS number_injured_lleus,
         coalesce(a.number_injured_greu, 0) AS number_injured_greu,
         coalesce(a.number_accident_victims, 0) AS number_accident_victims,
         coalesce(a.number_of_accidents, 0) AS number_of_accidents,
         coalesce(c.number_of_cultural_sites, 0) AS number_of_cultural_sites,
         coalesce(c.average_antiquity_cultural_sites, 0.0) AS average_antiquity_cultural_sites,
         p.average_price_per_square_meter
  FROM p
  LEFT JOIN a ON p.join_neigh = a.join_neigh AND p.year = a.year
  LEFT JOIN c ON p.join_neigh = c.join_neigh
"""


def round_cols(sql: str, cols: list[str], digits: int = 4, keep: list[str] | None = None) -> str:
    """Wrap ``sql`` so the named float columns are rounded."""
    sel = ", ".join([f"{sround(c, digits)} AS {c}" for c in cols])
    rest = "* EXCLUDE (" + ", ".join(cols) + ")"
    return f"SELECT {rest}, {sel} FROM ({sql}) q"
