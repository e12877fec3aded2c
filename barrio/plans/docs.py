"""Nested landing documents derived from the test tables.

Price documents: one per supplier (the "area"), ``info`` = its yearly
metrics in year order -- the shape of a neighbourhood price history.  The
array holds one entry per calendar year, so its size is bounded by the
number of years whatever the data volume; facts are aggregated to
(supplier, year) before anything is collected.

Site documents: one per customer, ``addresses`` = the distinct order
priorities of its 1998 orders (at most five entries), null when it placed
none that year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.plans.tables import table

ADDRESS_YEAR_FROM, ADDRESS_YEAR_TO = "1998-01-01", "1999-01-01"


def yearly_supplier_metrics(spark: SparkSession, d: str, before: str | None = None,
                            digits: int | None = 4) -> DataFrame:
    li = table(spark, d, "lineitem")
    if before is not None:
        li = li.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(F.lit(0.0))

    def r(c):
        return F.round(c, digits) if digits is not None else c

    return li.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        r(F.avg(F.try_divide("l_extendedprice", "l_quantity"))).alias("PerMeter"),
        r(F.sum("l_extendedprice")).alias("Amount"),
        r(F.sum(net)).alias("usedAmount"),
        r(F.avg(F.try_divide(net, F.col("l_quantity")))).alias("usedPerMeter"),
        r(F.nullif(F.sum(returned), F.lit(0.0))).alias("diffAmount"),
        F.round(F.sum("l_discount"), 2).alias("diffPerMeter"),
    )


def price_docs(spark: SparkSession, d: str, before: str | None = None, area: str = "supplier",
               digits: int | None = 4) -> DataFrame:
    """One history per supplier; its area name is the supplier's own name or,
    with ``area="nation"``, its nation's name.  Metrics rounded to ``digits``
    (None keeps full precision)."""
    y = yearly_supplier_metrics(spark, d, before, digits)
    entry = F.struct("year", "PerMeter", "Amount", "usedAmount", "usedPerMeter",
                     "diffAmount", "diffPerMeter")
    hist = y.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(entry)).alias("info"))
    supp = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    return (supp.join(nat, supp.s_nationkey == nat.n_nationkey)
                .join(hist, supp.s_suppkey == hist.l_suppkey, "left")
                .select(F.col("s_suppkey").alias("_id"), F.col("s_nationkey").alias("district_id"),
                        F.col("n_name").alias("district_name"),
                        F.col("n_name" if area == "nation" else "s_name").alias("neigh_name "),
                        "info"))


def site_docs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter(
        (F.col("o_orderdate") >= F.lit(ADDRESS_YEAR_FROM).cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit(ADDRESS_YEAR_TO).cast("timestamp_ntz")))
    pairs = o.select("o_custkey", "o_orderpriority").distinct()
    addr = pairs.groupBy("o_custkey").agg(F.array_sort(F.collect_list(
        F.struct(F.col("o_orderpriority").alias("neighborhood_name")))).alias("addresses"))
    cust = table(spark, d, "customer").select("c_custkey", "c_name")
    return (cust.join(addr, cust.c_custkey == addr.o_custkey, "left")
                .select(F.col("c_custkey").alias("register_id"), F.col("c_name").alias("name"),
                        "addresses"))
