"""Queries of leak-free validation, of baselines and of landing documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barrio import zones
from barrio.operators.models import LABEL, confusion
from barrio.operators.registry import accuracy_report, champion, leaderboard, metrics_wide, register
from barrio.operators.validation import origin_times, with_group_folds, with_origins
from barrio.plans import area_year as ay
from barrio.plans import baselines, ml, sql
from barrio.plans.catalog import query, rounded
from barrio.plans.queries_model import CATALOG_SQL, CLASSED, RES_YEAR_SQL, _catalog
from barrio.plans.tables import table
from barrio.session import scratch_path
from barrio.sources.files import list_files, read_catalog, read_csv
from barrio.sources.ledger import plan_resources
from barrio.sources.sinks import json_writer, land_csv_by_year
from barrio.sources.versioned import read_table


def _hash32(parts: list[str], seed: int) -> str:
    return (f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)}, '{seed}')), 1, 8)) AS BIGINT)")


ORDER_CELLS = f"""
  SELECT o.o_orderkey, lower(trim(n.n_name)) AS neighborhood_name, CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (SELECT DISTINCT lower(trim(n.n_name)) AS area, CAST(year(l.l_shipdate) AS INTEGER) AS y
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey) u
    ON u.area = lower(trim(n.n_name)) AND u.y = CAST(year(o.o_orderdate) AS INTEGER)
"""
_CELL = ["neighborhood_name", "CAST(year AS VARCHAR)"]


@query("grouped_folds", f"""
  SELECT o_orderkey, neighborhood_name, year, split,
         CASE WHEN split = 'train' THEN CAST({_hash32(_CELL, 43)} % 3 AS INTEGER) END AS fold
  FROM (SELECT *, CASE WHEN {_hash32(_CELL, 42)} % 10000 < 7000 THEN 'train' ELSE 'validation' END AS split
        FROM ({ORDER_CELLS}) c) q
""")
def grouped_folds(spark, d):
    """Split and fold of every order, by its cell: no cell on both sides."""
    rows = ml.order_frame(spark, d).select("o_orderkey", *ml.CELL)
    return with_group_folds(rows, ml.CELL)


@query("rolling_origin_rows", f"""
  WITH c AS ({ORDER_CELLS}), years AS (SELECT DISTINCT year FROM c),
  origins AS (SELECT year AS origin FROM years WHERE year > (SELECT min(year) FROM years) ORDER BY year DESC LIMIT 3)
  SELECT origin, CASE WHEN year < origin THEN 'train' ELSE 'validation' END AS side,
         count(*) AS orders, count(DISTINCT (neighborhood_name, year)) AS cells, max(year) AS last_year
  FROM c JOIN origins ON year <= origin GROUP BY 1, 2
""")
def rolling_origin_rows(spark, d):
    """What each origin trains on (earlier years) and is scored on (its year)."""
    rows = ml.order_frame(spark, d).select(*ml.CELL)
    cells = rows.groupBy(*ml.CELL).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    return with_origins(cells, "year", origin_times(cells, "year")).groupBy("origin", "side").agg(
        F.sum("n").alias("orders"), F.count(F.lit(1)).alias("cells"), F.max("year").alias("last_year"))


@query("tune_tree_rolling")
def tune_tree_rolling(spark, d):
    """M9 + M11 + M13: the tree's best depth by rolling origin, one row a year scored."""
    res = ml.rolling(spark, d, "decision_tree")
    rows = [(res.family, int(o.time), int(o.params["maxDepth"]), float(o.metrics["accuracy"]), float(res.mean_accuracy))
            for o in res.origins]
    return spark.createDataFrame(rows, "model string, year int, max_depth int, accuracy double, mean_accuracy double")


# ------------------------------------------------------------------ baselines

SCORED = f"""
  SELECT * FROM (
    SELECT neighborhood_name, year, price_category, lag(price_category, 1) OVER w AS last_year,
           lag(price_category, 2) OVER w AS two_years_ago,
           CASE WHEN n0 >= n1 AND n0 >= n2 THEN 0.0 WHEN n1 >= n2 THEN 1.0 ELSE 2.0 END::DOUBLE AS usual
    FROM (SELECT *, {', '.join(f"count(*) FILTER (WHERE price_category = {c}) OVER (PARTITION BY neighborhood_name ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n{c}" for c in range(3))}
          FROM ({CLASSED}) k) s
    WINDOW w AS (PARTITION BY neighborhood_name ORDER BY year)) b
  JOIN (SELECT lower(trim(n.n_name)) AS area, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS orders
        FROM orders JOIN customer c ON o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2) o
    ON o.area = b.neighborhood_name AND o.y = b.year
  WHERE two_years_ago IS NOT NULL
"""
CONFUSION = f"""
  WITH s AS ({SCORED})
  {' UNION ALL '.join(f"SELECT '{b}' AS model, {i} AS pos, price_category AS actual, {b} AS predicted, CAST(sum(orders) AS BIGINT) AS orders FROM s GROUP BY price_category, {b}" for i, b in enumerate(baselines.BASELINES))}
"""
BOARD = f"""
  WITH cm AS ({CONFUSION}), classes AS (SELECT DISTINCT model, actual AS c FROM cm UNION SELECT DISTINCT model, predicted FROM cm),
  per AS (
    SELECT k.model, k.c, any_value(pos) AS pos, sum(orders) FILTER (WHERE actual = k.c AND predicted = k.c) AS tp,
           sum(orders) FILTER (WHERE actual = k.c) AS t, sum(orders) FILTER (WHERE predicted = k.c) AS p, sum(orders) AS n
    FROM classes k JOIN cm ON cm.model = k.model GROUP BY 1, 2),
  rates AS (SELECT *, coalesce(tp, 0) / nullif(p, 0) AS prec, coalesce(tp, 0) / nullif(t, 0) AS rec, coalesce(t, 0) / n AS w FROM per),
  m AS (
    SELECT model, any_value(pos) AS pos, sum(coalesce(tp, 0)) / any_value(n) AS acc, sum(w * coalesce(rec, 0)) AS rec,
           sum(w * coalesce(prec, 0)) AS prec,
           sum(w * CASE WHEN coalesce(prec, 0) + coalesce(rec, 0) > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END) AS f1
    FROM rates GROUP BY model)
"""
_METRIC = {"Accuracy": "acc", "Recall": "rec", "Precision": "prec", "F1": "f1"}


@query("baseline_confusion", f"SELECT model, actual, predicted, orders FROM ({CONFUSION}) c")
def baseline_confusion(spark, d):
    """Orders by true and foretold class, for each baseline."""
    cells = baselines.scored_cells(spark, d)
    parts = [confusion(cells, LABEL, b, "orders").select(
        F.lit(b).alias("model"), F.col("y").alias("actual"), F.col("p").alias("predicted"), F.col("count").alias("orders"))
        for b in baselines.BASELINES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _board(spark, d):
    return leaderboard(spark, baselines.results(baselines.scored_cells(spark, d)))


@query("baseline_leaderboard", f"""
  {BOARD} {' UNION ALL '.join(f"SELECT model, '{name}' AS metric, {sql.sround(c, 4)} AS value, v AS version FROM m, (VALUES (1), (2)) t(v)" for name, c in _METRIC.items())}
""")
def baseline_leaderboard(spark, d):
    """M14 + L1: all metrics in long form, registered twice: versions 1 and 2."""
    board, path = _board(spark, d), scratch_path(spark, "baseline-registry")
    register(spark, board, path)
    register(spark, board, path)
    return rounded(spark.read.parquet(path).select("model", "metric", "value", "version"))


@query("baseline_report", f"""
  {BOARD} SELECT model, {sql.sround('acc', 4)} AS value, {sql.sround('max(acc) OVER () + 0.2', 4)} AS axis_max,
                 CAST(row_number() OVER (ORDER BY acc DESC, model) AS INTEGER) AS place,
                 {', '.join(f'{sql.sround(c, 4)} AS "{name}"' for name, c in _METRIC.items())} FROM m
""")
def baseline_report(spark, d):
    """S9 + F7/O3/A6 + A9: results written as CSV, scanned back, ranked by one
    metric with the chart domain, and pivoted wide."""
    path = scratch_path(spark, "baseline-csv")
    _board(spark, d).select("model", "metric", "value").write.option("header", "true").csv(path)
    found = read_csv(spark, path, schema="model string, metric string, value double")
    place = F.row_number().over(Window.orderBy(F.desc("value"), F.asc("model"))).cast("int")
    ranked = accuracy_report(found).select("model", "value", "axis_max", place.alias("place"))
    return rounded(ranked.join(metrics_wide(found), "model"))


@query("baseline_champion", f"""
  {BOARD} SELECT model, {sql.sround('acc', 4)} AS value FROM m ORDER BY acc DESC, pos LIMIT 1
""")
def baseline_champion(spark, d):
    """O2: the best baseline; of equals the earlier one."""
    return rounded(champion(_board(spark, d)).select("model", "value"))

# ---------------------------------------------------------- landing documents


@query("skip_landed_years", f"""
  SELECT id, format, url, name, dataset, position, {RES_YEAR_SQL} AS year FROM ({CATALOG_SQL}) c
  WHERE upper(format) = 'CSV' AND {RES_YEAR_SQL} <> 0 AND {RES_YEAR_SQL} NOT IN (
    SELECT CAST(year(o_orderdate) AS INTEGER) FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) < 2001)
""")
def skip_landed_years(spark, d):
    """F5 + S6 + S11: the catalog is read from a response document, the years
    that have landed from the landing folder's own listing."""
    root = scratch_path(spark, "landed")
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    land_csv_by_year(orders.where((F.col("o_orderstatus") == "F") & (F.col("year") < 2001)), f"{root}/incidents")
    resource = F.struct(*_catalog(spark, d).columns)
    # one response: years x priorities records
    response = _catalog(spark, d).agg(F.to_json(F.struct(F.struct(F.sort_array(F.collect_list(resource)).alias("resources"))
                                                          .alias("result"))).alias("value"))
    response.write.text(f"{root}/catalog")
    landed = list_files(spark, f"{root}/incidents", "*.csv").select(
        F.regexp_extract("path", r"year=(\d{4})", 1).cast("int").alias("year"))
    catalog = read_catalog(spark, f"{root}/catalog").select(
        "id", "format", "url", "name", F.col("dataset").cast("int").alias("dataset"),
        F.col("position").cast("int").alias("position"))
    return plan_resources(catalog, landed)


DOCUMENT_SITES = 1000        # sites of one landed document


@query("site_documents", f"""
  SELECT CAST(register_id AS VARCHAR) AS register_id, neighborhood_name, strftime(created, '%Y-%m-%d') AS created
  FROM ({sql.SITE_RECORDS}) s
""")
def site_documents(spark, d):
    """Sites land as whole documents (a JSON array of up to 1000 over many
    lines each), are read as such and upserted."""
    root = scratch_path(spark, "site-documents")
    site = F.struct(F.col("register_id").cast("string").alias("register_id"), F.lit(None).cast("string").alias("name"),
                    F.date_format("created", "yyyy-MM-dd").alias("created"),
                    F.array(F.struct("neighborhood_name")).alias("addresses"))
    documents = (ay.site_records(spark, d).select(F.expr(f"register_id div {DOCUMENT_SITES}").alias("doc"), site.alias("s"))
                 .groupBy("doc").agg(F.collect_list("s").alias("s")))
    lines = documents.select("doc", F.to_json("s", {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
    lines.repartition("doc").write.partitionBy("doc").text(f"{root}/landing")
    zones.format_site_files(spark, f"{root}/landing", f"{root}/sites", f"{root}/ledger", pattern="*.txt", documents=True)
    return read_table(spark, f"{root}/sites").select("register_id", "neighborhood_name", "created")
