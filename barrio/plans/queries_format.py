"""Formatting-zone queries: flattening, watermarks, dedupe, keys, headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from barrio.functions.keys import composite_key, year_from_file
from barrio.operators import aggregates as agg
from barrio.operators.dedupe import keep_one
from barrio.operators.nested import flatten_addresses, format_prices, format_sites
from barrio.operators.normalize import INCIDENT_TYPES, conform, normalize_headers
from barrio.plans import docs, sql
from barrio.plans.catalog import query, rounded
from barrio.plans.tables import table

_METRICS = ["price_per_meter", "total_amount", "used_amount", "diff_amount", "diff_price_per_meter"]

FLAT_PRICES = f"""
  SELECT CAST(s.s_suppkey AS INTEGER) AS neighborhood_id, s.s_nationkey AS district_id,
         n.n_name AS district_name, s.s_name AS neighborhood_name, y.year,
         y.PerMeter AS price_per_meter, y.Amount AS total_amount, y.usedAmount AS used_amount,
         y.diffAmount AS diff_amount, y.diffPerMeter AS diff_price_per_meter,
         concat_ws('-', CAST(s.s_suppkey AS INTEGER), y.year) AS _id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
               {sql.sround("avg(l_extendedprice / nullif(l_quantity, 0))", 4)} AS PerMeter,
               {sql.sround("sum(l_extendedprice)", 4)} AS Amount,
               {sql.sround("sum(l_extendedprice * (1.0 - l_discount))", 4)} AS usedAmount,
               {sql.sround("nullif(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END), 0.0)", 4)}
                 AS diffAmount,
               {sql.sround("sum(l_discount)", 2)} AS diffPerMeter
        FROM lineitem {{where}} GROUP BY 1, 2) y ON s.s_suppkey = y.l_suppkey
"""


def _flat(where: str = "") -> str:
    return FLAT_PRICES.format(where=where)


@query("nested_flatten", f"SELECT * EXCLUDE ({', '.join(_METRICS)}), "
       + ", ".join(f"{sql.sround(m, 4)} AS {m}" for m in _METRICS) + f" FROM ({_flat()}) q")
def nested_flatten(spark, d):
    return rounded(format_prices(docs.price_docs(spark, d)))


@query("incremental_rows", f"""
  WITH earlier AS ({_flat("WHERE l_shipdate < TIMESTAMP '1999-07-01'")}),
       ledger AS (SELECT neighborhood_id, max(year) AS last_year FROM earlier GROUP BY 1),
       cur AS ({_flat()})
  SELECT cur.* EXCLUDE ({', '.join(_METRICS)}), {', '.join(f'{sql.sround("cur." + m, 4)} AS {m}' for m in _METRICS)}
  FROM cur LEFT JOIN ledger USING (neighborhood_id)
  WHERE cur.year > coalesce(ledger.last_year, 0)
""")
def incremental_rows(spark, d):
    """F1 + A4: per-document watermark from an earlier landing, new years only."""
    earlier = format_prices(docs.price_docs(spark, d, before="1999-07-01"))
    ledger = agg.max_per_group(earlier, ["neighborhood_id"], "year", "last_year")
    cur = docs.price_docs(spark, d)
    joined = cur.join(ledger, cur["_id"] == ledger["neighborhood_id"], "left").drop("neighborhood_id")
    return rounded(format_prices(joined, last_year=F.coalesce(F.col("last_year"), F.lit(0))))


SITE_PAIRS = """
  customer c LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders
                        WHERE o_orderdate >= TIMESTAMP '1998-01-01'
                          AND o_orderdate < TIMESTAMP '1999-01-01') p
  ON c.c_custkey = p.o_custkey
"""


@query("outer_flatten", f"""
  SELECT c.c_custkey AS register_id, c.c_name AS entity_name, p.o_orderpriority AS neighborhood_name
  FROM {SITE_PAIRS}
""")
def outer_flatten(spark, d):
    return flatten_addresses(docs.site_docs(spark, d))


@query("dedupe_after_explode", f"""
  SELECT register_id, entity_name, neighborhood_name FROM (
    SELECT c.c_custkey AS register_id, c.c_name AS entity_name, p.o_orderpriority AS neighborhood_name,
           row_number() OVER (PARTITION BY c.c_custkey
                              ORDER BY lower(trim(p.o_orderpriority)) NULLS LAST, c.c_name,
                                       p.o_orderpriority NULLS LAST) AS rn
    FROM {SITE_PAIRS}) q
  WHERE rn = 1
""")
def dedupe_after_explode(spark, d):
    return format_sites(docs.site_docs(spark, d))


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedupe_first", f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY {', '.join(c + ' NULLS LAST' for c in _LI_REST)}) AS rn
    FROM lineitem) q
  WHERE rn = 1
""")
def dedupe_first(spark, d):
    """One row per (l_orderkey, l_linenumber), smallest remaining columns win."""
    return keep_one(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("composite_key", """
  SELECT o_orderkey,
         CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN NULL
              ELSE concat_ws('-', o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER)) END AS _id
  FROM orders
""")
def composite_key_query(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", composite_key(
        "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")), F.year("o_orderdate")).alias("_id"))


@query("normalize_headers", """
  SELECT CAST(event_id AS VARCHAR) AS expedient_id, CAST(year(ts) AS INTEGER) AS year,
         CAST(NULL AS INTEGER) AS district_id, CAST(NULL AS VARCHAR) AS district_name,
         CAST(user_id AS INTEGER) AS neighborhood_id, event_type AS neighborhood_name,
         CAST(trunc(value) AS BIGINT) AS num_victims, CAST(NULL AS BIGINT) AS num_deaths,
         CAST(NULL AS BIGINT) AS num_minor_injuries, CAST(NULL AS BIGINT) AS num_serious_injuries,
         props AS Carrer_den_X, ts AS "a.b"
  FROM events
""")
def normalize_headers_query(spark, d):
    """P3-P5 + P7 on events re-labelled with drifting incident headers."""
    e = table(spark, d, "events")
    raw = e.select(
        F.col("event_id").alias("Numero_expedient"),
        F.year("ts").alias("NK Any"),
        F.date_format("ts", "yyyy").alias("Any"),          # second year header: dropped
        F.col("user_id").alias(" Codi barri "),
        F.col("event_type").alias("Nom barri"),
        F.col("value").alias("Numero_victimes"),
        F.col("props").alias("Carrer d'en X"),              # unmapped: sanitized
        F.col("ts").alias("a.b"),                           # dotted header kept verbatim
    )
    return conform(normalize_headers(raw), INCIDENT_TYPES)


_PATH_SQL = ("'landing/incidents/year_' || CAST(year(o_orderdate) AS INTEGER) || '/' || "
             "CASE WHEN o_orderstatus = 'F' THEN 'incidents_' || CAST(year(o_orderdate) AS INTEGER) "
             "|| '.csv' ELSE 'part.csv' END")


@query("year_from_path", f"""
  SELECT o_orderkey, {_PATH_SQL} AS file_path,
         coalesce(TRY_CAST(nullif(regexp_extract(regexp_extract({_PATH_SQL}, '[^/]*$', 0), '(\\d{{4}})', 1), '')
                           AS INTEGER),
                  TRY_CAST(nullif(regexp_extract({_PATH_SQL}, 'year_(\\d{{4}})', 1), '') AS INTEGER)) AS year
  FROM orders
""")
def year_from_path(spark, d):
    """P6 on landed paths: 4 digits in the base name, else a year_YYYY folder."""
    o = table(spark, d, "orders")
    y = F.year("o_orderdate").cast("string")
    name = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("incidents_"), y, F.lit(".csv"))) \
            .otherwise(F.lit("part.csv"))
    path = F.concat(F.lit("landing/incidents/year_"), y, F.lit("/"), name)
    p = o.select("o_orderkey", path.alias("file_path"))
    return p.select("o_orderkey", "file_path", year_from_file(
        F.element_at(F.split("file_path", "/"), -1), F.col("file_path")).alias("year"))


@query("default_missing_column", """
  SELECT lower(trim(o_orderpriority)) AS neighborhood_name, CAST(year(o_orderdate) AS INTEGER) AS year,
         'UNKNOWN' AS neighborhood_code, CAST(count(*) AS BIGINT) AS number_of_accidents,
         CAST(0 AS BIGINT) AS number_accident_victims,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS accident_deaths,
         CAST(0 AS BIGINT) AS number_injured_lleus, CAST(0 AS BIGINT) AS number_injured_greu
  FROM orders GROUP BY 1, 2
""")
def default_missing_column(spark, d):
    """No code, victim or injury columns -> typed nulls -> filled."""
    o = table(spark, d, "orders")
    acc = o.select(F.col("o_orderpriority").alias("neighborhood_name"),
                   F.year("o_orderdate").alias("year"),
                   (F.col("o_orderstatus") == "F").cast("bigint").alias("num_deaths"))
    t = agg.incident_totals(acc)
    zero = F.lit(0).cast("bigint")
    return t.select(
        F.col("join_neigh").alias("neighborhood_name"), "year",
        F.coalesce(F.col("neighborhood_code").cast("string"), F.lit("UNKNOWN")).alias("neighborhood_code"),
        "number_of_accidents",
        F.coalesce("number_accident_victims", zero).alias("number_accident_victims"),
        "accident_deaths", "number_injured_lleus", "number_injured_greu")
