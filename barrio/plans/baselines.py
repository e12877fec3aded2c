"""Baselines a trained model must beat, simple enough for SQL to check.

The price class of a cell (area, year) is foretold from the area's earlier
years alone: last year's class, the class two years ago, or the class it had
most often so far (of equals the lowest).  Cells with two earlier years are
scored, each with the number of its orders.  The reports that rank trained
models (leaderboard, champion, accuracy report, wide form) run on these too,
so an SQL engine can check them number by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barrio.functions.keys import norm_key
from barrio.operators.label import label_by_quantiles
from barrio.operators.models import LABEL, TuneResult, classification_metrics
from barrio.plans import area_year as ay
from barrio.plans.tables import table

PRICE = "average_price_per_square_meter"
BASELINES = ("last_year", "two_years_ago", "usual")
CLASSES = (0.0, 1.0, 2.0)


def orders_per_cell(spark: SparkSession, d: str) -> DataFrame:
    """Orders of each (area, year), counted before the joins."""
    o = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", norm_key("n_name").alias("neighborhood_name"))
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("neighborhood_name", "year").agg(F.sum("n").alias("orders")))


def with_baselines(cells: DataFrame, area: str = "neighborhood_name", time: str = "year", label: str = LABEL) -> DataFrame:
    """Cells with two earlier years and a column for each baseline."""
    by_time = Window.partitionBy(area).orderBy(time)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.array(*[F.struct(F.sum((F.col(label) == c).cast("int")).over(so_far).alias("n"), F.lit(-c).alias("c"))
                     for c in CLASSES])
    return (cells.withColumn("last_year", F.lag(label, 1).over(by_time))
            .withColumn("two_years_ago", F.lag(label, 2).over(by_time))
            .withColumn("usual", -F.array_max(seen)["c"])
            .where(F.col("two_years_ago").isNotNull()))


def scored_cells(spark: SparkSession, d: str) -> DataFrame:
    """neighborhood_name, year, class, the baselines' classes and orders: areas x
    years rows, checkpointed because every report reads them."""
    u = ay.unified(spark, d).select("neighborhood_name", "year", PRICE).checkpoint(eager=True)
    labelled, _ = label_by_quantiles(u, PRICE, relative_error=0.0)
    return (with_baselines(labelled).join(orders_per_cell(spark, d), ["neighborhood_name", "year"])
            .select("neighborhood_name", "year", LABEL, *BASELINES, "orders").checkpoint(eager=True))


def results(cells: DataFrame) -> list[TuneResult]:
    """M13/M14 of each baseline, over the orders of the scored cells."""
    return [TuneResult(b, None, classification_metrics(cells, LABEL, b, "orders"), {}, 0.0, 1) for b in BASELINES]
