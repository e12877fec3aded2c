"""The area x year model built from the TPC-H-like test tables.

Mapping (the source data is neighbourhood prices, incidents and sites):
    area                 nation name, normalized
    year                 year(l_shipdate) for prices, year(o_orderdate) otherwise
    price per m2         l_extendedprice / l_quantity, area = supplier's nation
    incidents            1-URGENT orders placed from 1997 on, area = customer's nation
      victims            floor(o_totalprice / 100000), null when 0
      deaths / minor / serious injuries   orders in status F / O / P
    cultural sites       BUILDING-segment customers, area = customer's nation
      created            the customer's first order date (none -> antiquity 0)
    as_of                2002-01-01

Facts are pre-aggregated at the entity grain (supplier x year, customer x
year) before the dimension joins: a hot supplier or customer collapses
map-side, and the joins move one row per entity-year, not per fact.

No broadcast hints: the planner broadcasts a side only when its size
(file statistics at plan time, shuffle statistics under AQE at run time)
is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges beyond
it, so ``nation`` is broadcast while a 10^9-row ``supplier`` is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.functions.keys import norm_key
from barrio.operators import aggregates as agg
from barrio.operators.unify import join_coverage, unified_model
from barrio.plans.tables import table

# Fixed values of the mapping above.
AS_OF = "2002-01-01"
INCIDENT_PRIORITY = "1-URGENT"
INCIDENTS_FROM = "1997-01-01"
SITE_SEGMENT = "BUILDING"
VICTIM_UNIT = 100000.0


def nations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", norm_key("n_name").alias("join_neigh"))


def price_groups(spark: SparkSession, d: str) -> DataFrame:
    """A1 over lineitem: mean unit price per (supplier nation, ship year)."""
    li = table(spark, d, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"))
    part = agg.mean_partial(li, ["l_suppkey", "year"], "unit_price")
    supp = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    j = (part.join(supp, part.l_suppkey == supp.s_suppkey)
             .join(nations(spark, d), F.col("s_nationkey") == F.col("n_nationkey")))
    return agg.mean_merge(j, ["join_neigh", "year"], "average_price_per_square_meter")


def incident_records(spark: SparkSession, d: str) -> DataFrame:
    """Order-level incident rows in the canonical incident columns (no area yet)."""
    o = table(spark, d, "orders").filter(
        (F.col("o_orderpriority") == INCIDENT_PRIORITY)
        & (F.col("o_orderdate") >= F.lit(INCIDENTS_FROM).cast("timestamp_ntz")))
    status = F.col("o_orderstatus")
    return o.select(
        "o_custkey", F.year("o_orderdate").alias("year"),
        F.lit(None).cast("int").alias("neighborhood_code"),
        F.nullif(F.floor(F.col("o_totalprice") / VICTIM_UNIT), F.lit(0)).cast("bigint").alias("num_victims"),
        (status == "F").cast("bigint").alias("num_deaths"),
        F.when(status == "O", F.lit(1).cast("bigint")).alias("num_minor_injuries"),
        F.when(status == "P", F.lit(1).cast("bigint")).alias("num_serious_injuries"),
    )


def incident_groups(spark: SparkSession, d: str) -> DataFrame:
    """A2 over orders: totals per (customer nation, order year)."""
    part = agg.incident_partial(incident_records(spark, d), ["o_custkey", "year"])
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = (part.join(cust, part.o_custkey == cust.c_custkey)
             .join(nations(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
             .withColumn("neighborhood_code", F.col("n_nationkey")))
    return agg.incident_merge(j, ["join_neigh", "year"])


def site_records(spark: SparkSession, d: str) -> DataFrame:
    """Cultural-site rows: BUILDING customers with their first order date."""
    first = (table(spark, d, "orders").groupBy("o_custkey")
             .agg(F.min("o_orderdate").alias("created")))
    cust = (table(spark, d, "customer").filter(F.col("c_mktsegment") == SITE_SEGMENT)
            .select("c_custkey", "c_nationkey"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return (cust.join(first, cust.c_custkey == first.o_custkey, "left")
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("register_id"),
                        F.col("n_name").alias("neighborhood_name"), "created"))


def site_groups(spark: SparkSession, d: str) -> DataFrame:
    return agg.site_totals(site_records(spark, d), AS_OF)


def unified(spark: SparkSession, d: str, flags: bool = False) -> DataFrame:
    """The flagship: unified 11-column area x year model."""
    return unified_model(price_groups(spark, d), incident_groups(spark, d),
                         site_groups(spark, d), flags=flags)


def coverage(spark: SparkSession, d: str) -> DataFrame:
    return join_coverage(price_groups(spark, d), incident_groups(spark, d), site_groups(spark, d))
