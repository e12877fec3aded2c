"""End to end over the zones: landing -> formatted -> exploitation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barrio import zones
from barrio.plans import area_year as ay
from barrio.operators import maintain
from barrio.plans import docs, sql
from barrio.plans.catalog import query, rounded
from barrio.plans.tables import table
from barrio.session import scratch_path
from barrio.sources.sinks import json_writer, land_json, replace_snapshot
from barrio.streaming.incremental import incremental_load

ZONE_PRICES = """
  SELECT lower(trim(n.n_name)) AS join_neigh, y.year, avg(y.PerMeter) AS average_price_per_square_meter
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
               avg(l_extendedprice / nullif(l_quantity, 0)) AS PerMeter
        FROM lineitem GROUP BY 1, 2) y ON s.s_suppkey = y.l_suppkey
  GROUP BY 1, 2
"""

ZONES_UNIFIED = sql.UNIFIED.replace(f"p AS ({sql.PRICE_GROUPS})", f"p AS ({ZONE_PRICES})")


def _incident_landing(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    orders = table(spark, d, "orders").filter(
        (F.col("o_orderpriority") == ay.INCIDENT_PRIORITY)
        & (F.col("o_orderdate") >= F.lit(ay.INCIDENTS_FROM).cast("timestamp_ntz")))
    rec = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         F.year("o_orderdate").alias("year"))
           .join(c, F.col("o_custkey") == F.col("c_custkey"))
           .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    status = F.col("o_orderstatus")
    return rec.select(
        "o_orderkey", "c_nationkey", "n_name", "year",
        F.nullif(F.floor(F.col("o_totalprice") / ay.VICTIM_UNIT), F.lit(0)).cast("bigint").alias("victims"),
        (status == "F").cast("int").alias("deaths"),
        F.when(status == "O", F.lit(1)).alias("minor"),
        F.when(status == "P", F.lit(1)).alias("serious"))


@query("zones_end_to_end", sql.round_cols(ZONES_UNIFIED, [
        "average_antiquity_cultural_sites", "average_price_per_square_meter"]))
def zones_end_to_end(spark, d):
    """S1-S6 + K1-K7 + W1 + J-3: every source landed, formatted
    incrementally (a second run finds nothing new) and unified."""
    root = scratch_path(spark, "zones")
    # landing zone
    land_json(docs.price_docs(spark, d, area="nation", digits=None), f"{root}/landing/prices", "b1")
    inc = _incident_landing(spark, d)
    (json_writer(inc.filter(F.col("year") <= 1998).select(
        F.col("o_orderkey").alias("Numero_expedient"), F.col("c_nationkey").alias("Codi_barri"),
        F.col("n_name").alias("Nom_barri"), F.col("year").alias("NK_Any"),
        F.col("victims").alias("Numero_victimes"), F.col("deaths").alias("Numero_morts"),
        F.col("minor").alias("Numero_lesionats_lleus"), F.col("serious").alias("Numero_lesionats_greus"),
        "year"))
     .option("header", "true").partitionBy("year").csv(f"{root}/landing/incidents/layout_a"))
    (json_writer(inc.filter(F.col("year") > 1998).select(
        F.col("o_orderkey").alias("Número d'expedient"), F.col("c_nationkey").alias("Codi barri"),
        F.col("n_name").alias("Nom barri"), F.col("year").alias("NK Any"),
        F.col("victims").alias("Numero_victimes"), F.col("deaths").alias("Numero_morts"),
        F.col("minor").alias("Numero_lesionats_lleus"), F.col("serious").alias("Numero_lesionats_greus"),
        "year"))
     .option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1")
     .partitionBy("year").csv(f"{root}/landing/incidents/layout_b"))
    sites = ay.site_records(spark, d)
    replace_snapshot(sites.select(
        F.col("register_id").cast("string").alias("register_id"), F.lit(None).cast("string").alias("name"),
        F.date_format("created", "yyyy-MM-dd").alias("created"),
        F.array(F.struct(F.col("neighborhood_name"))).alias("addresses")), f"{root}/landing/sites")
    # formatted zone, twice: the second pass must find nothing to do
    for _ in range(2):
        zones.format_price_files(spark, f"{root}/landing/prices", f"{root}/formatted/prices",
                                 f"{root}/ledger/prices")
        zones.format_incident_files(spark, f"{root}/landing/incidents", f"{root}/formatted/incidents",
                                    f"{root}/ledger/incidents")
        zones.format_site_files(spark, f"{root}/landing/sites", f"{root}/formatted/sites",
                                f"{root}/ledger/sites")
    # exploitation zone
    out = zones.build_exploitation(spark, f"{root}/formatted/prices", f"{root}/formatted/incidents",
                                   f"{root}/formatted/sites", f"{root}/exploitation", ay.AS_OF)
    return rounded(out.select(*[c for c in out.columns if c != "year"], F.col("year").cast("int")))


def _dropped(rows, key, wrong):
    """Three drops of keyed rows: a third of the rows comes late, a fifth with
    wrong values first, put right in the second or third drop."""
    k = F.pmod(F.xxhash64(*key), F.lit(30))
    bad = k % 5 == 0
    first = rows.where(k % 3 > 0)
    columns = [F.when(bad, wrong[c]).otherwise(F.col(c)).alias(c) if c in wrong else F.col(c) for c in rows.columns]
    return [first.select(*columns), rows.where((k % 3 == 0) | (k % 10 == 0)), rows.where(bad & (k % 10 > 0))]


@query("unified_incremental", sql.round_cols(sql.UNIFIED, [
        "average_antiquity_cultural_sites", "average_price_per_square_meter"]))
def unified_incremental(spark, d):
    """A1-A3 + W1: three drops of each source are loaded one after the other;
    what each changes is merged into stored sums, and the unified model read
    from these equals the full rebuild."""
    root = scratch_path(spark, "unified-incremental")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, d, "lineitem")
    # an order may hold a line number several times; lines equal in what follows are alike
    nth = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "year", "l_suppkey", "price_per_meter"))
    lines = lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.year("l_shipdate").alias("year"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price_per_meter")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", nth).alias("price_id"), "l_suppkey", "year", "price_per_meter")
    # the lines are numbered once, not for every drop
    numbered = scratch_path(spark, "numbered-prices")
    lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "price_id", F.col("n_name").alias("neighborhood_name"), "year", "price_per_meter").write.parquet(numbered)
    prices = spark.read.parquet(numbered)
    accidents = _incident_landing(spark, d).select(
        F.col("o_orderkey").alias("expedient_id"), F.col("c_nationkey").alias("neighborhood_id"),
        F.col("n_name").alias("neighborhood_name"), "year", F.col("victims").alias("num_victims"),
        F.col("deaths").alias("num_deaths"), F.col("minor").alias("num_minor_injuries"),
        F.col("serious").alias("num_serious_injuries"))
    sites = ay.site_records(spark, d).withColumn("created", F.date_format("created", "yyyy-MM-dd"))
    sources = {
        "prices": (prices, ["price_id"], maintain.PRICES, "year",
                   {"price_per_meter": F.col("price_per_meter") * 3, "neighborhood_name": F.lit("elsewhere")}),
        "incidents": (accidents, ["expedient_id"], maintain.INCIDENTS, "year",
                      {"neighborhood_id": F.lit(99).cast("int"), "num_victims": F.lit(None).cast("bigint")}),
        "sites": (sites, ["register_id"], maintain.SITES, None,
                  {"neighborhood_name": F.upper("neighborhood_name"), "created": F.lit("1990-01-01")}),
    }
    states = {}
    for drop in range(3):
        for name, (rows, key, spec, year, wrong) in sources.items():
            batch = _dropped(rows, key, wrong)[drop].withColumn("drop", F.lit(drop))
            json_writer(batch).option("compression", "gzip").json(f"{root}/landing/{name}/drop{drop}")
            incremental_load(spark, f"{root}/landing/{name}", f"{root}/ledger/{name}", f"{root}/formatted/{name}",
                             batch.schema, key, version=["drop"], partition_col=year, year_col=year,
                             pattern="*.json.gz", changes=True)
            states[name] = maintain.maintain(spark, f"{root}/formatted/{name}", f"{root}/state/{name}", spec)
    return rounded(maintain.unified_from_states(states["prices"], states["incidents"], states["sites"], ay.AS_OF))
