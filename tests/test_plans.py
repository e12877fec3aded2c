"""Plan-level guards: what each registered query may not do at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from barrio.operators.aggregates import incident_totals
from barrio.operators.dedupe import keep_one

SMALL = "/root/testdata/sf0.001"
MODEL_QUERIES = {"tune_logistic", "tune_forest", "tune_tree", "model_leaderboard", "model_report",
                 "champion_score"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - MODEL_QUERIES))
def test_no_cartesian_nested_loop_or_python_in_plans(spark, name):
    text = plan_text(E.queries()[name](spark, SMALL))
    assert not [op for op in FORBIDDEN if op in text]


def test_flagship_pushes_filters_and_prunes_columns(spark):
    text = plan_text(E.queries()["unified_area_year"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(o_orderpriority), IsNotNull(o_orderdate), EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_dedupe_combines_map_side_before_the_shuffle(spark):
    text = plan_text(keep_one(spark.range(10).withColumn("k", F.col("id") % 2), ["k"]), "simple")
    assert text.index("partial_min") > text.index("Exchange")       # partial agg sits below the exchange


def test_hot_key_holding_a_third_of_rows(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").alias("v"))
    out = keep_one(df, ["k"], ["v"], prefer="max")
    assert out.count() == 1 + 2 * n // 3
    assert out.filter("k = 'hot'").first()["v"] == n - 3
    acc = df.select(F.when(F.col("k") == "hot", "Hot").otherwise("Cold").alias("neighborhood_name"),
                    F.lit(2020).alias("year"), F.lit(1).alias("num_deaths"))
    got = {r["join_neigh"]: r["accident_deaths"] for r in incident_totals(acc).collect()}
    assert got == {"hot": n // 3, "cold": n - n // 3}


def test_bounded_broadcast_hints_only_within_the_bound(spark):
    from barrio.operators.joins import bounded_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # isolate the explicit hint
    try:
        big = spark.range(100_000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        hinted = plan_text(big.join(bounded_broadcast(small, max_rows=100), "k"), "simple")
        unhinted = plan_text(big.join(bounded_broadcast(big.select("k"), max_rows=100), "k"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in unhinted and "SortMergeJoin" in unhinted
