"""Label, projection, catalog, lakehouse round-trip and model queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barrio.functions.keys import resource_year
from barrio.operators.forecast import SERIES_METRICS, extend_history, projected_rows, series_trends
from barrio.operators.label import label_by_quantiles
from barrio.operators.models import FEATURES, TRAIN_ORDER, feature_prep, stable_split, with_split
from barrio.operators.registry import (accuracy_report, champion, leaderboard, metrics_wide, register,
                                       score)
from barrio.plans import area_year as ay
from barrio.plans import docs, ml, sql
from barrio.plans.catalog import query, rounded
from barrio.plans.tables import table
from barrio.session import scratch_path
from barrio.sources.ledger import first_resource, plan_resources
from barrio.sources.files import read_csv, read_jsonl
from barrio.sources.sinks import write_jsonl, write_partitioned

PRICE = "average_price_per_square_meter"

CLASSED = f"""
  WITH u AS ({sql.UNIFIED}),
  q AS (SELECT quantile_disc(average_price_per_square_meter, 0.33) AS p33,
               quantile_disc(average_price_per_square_meter, 0.67) AS p67
        FROM u WHERE average_price_per_square_meter IS NOT NULL)
  SELECT u.neighborhood_name, u.year, u.average_price_per_square_meter,
         CAST(CASE WHEN u.average_price_per_square_meter < q.p33 THEN 0
                   WHEN u.average_price_per_square_meter < q.p67 THEN 1 ELSE 2 END AS DOUBLE) AS price_category
  FROM u, q WHERE u.average_price_per_square_meter IS NOT NULL
"""


def _classed(spark, d):
    # The area x year table is small and bounded (areas x years), so the
    # cut points are exact here; row-level frames use the 0.01 sketch.  It is
    # checkpointed once: the sketch and the labelling then both read it
    # instead of re-running the lineitem/orders aggregates behind it.
    u = ay.unified(spark, d).select("neighborhood_name", "year", PRICE).checkpoint(eager=True)
    labelled, _ = label_by_quantiles(u, PRICE, relative_error=0.0)
    return labelled


@query("price_quantile_class", f"""
  SELECT neighborhood_name, year, {sql.sround("average_price_per_square_meter", 4)} AS average_price_per_square_meter,
         price_category FROM ({CLASSED}) c
""")
def price_quantile_class(spark, d):
    return rounded(_classed(spark, d))


@query("class_counts", f"""
  SELECT price_category, CAST(count(*) AS BIGINT) AS rows FROM ({CLASSED}) c GROUP BY 1
""")
def class_counts(spark, d):
    return _classed(spark, d).groupBy("price_category").agg(F.count(F.lit(1)).alias("rows"))


YEARLY = f"""
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
         {sql.sround("avg(l_extendedprice / nullif(l_quantity, 0))", 4)} AS PerMeter,
         {sql.sround("sum(l_extendedprice)", 4)} AS Amount,
         {sql.sround("sum(l_extendedprice * (1.0 - l_discount))", 4)} AS usedAmount,
         {sql.sround("avg(l_extendedprice * (1.0 - l_discount) / nullif(l_quantity, 0))", 4)} AS usedPerMeter
  FROM lineitem GROUP BY 1, 2
"""

TRENDS = f"""
  WITH y AS ({YEARLY}),
  t AS (SELECT l_suppkey, count(*) AS n,
        {', '.join(f"arg_max(coalesce({m}, 0.0), year) - arg_min(coalesce({m}, 0.0), year) AS s_{m}"
                   for m in SERIES_METRICS)}
        FROM y GROUP BY 1),
  last AS (SELECT l_suppkey, year AS last_year, {', '.join(f"coalesce({m}, 0.0) AS l_{m}" for m in SERIES_METRICS)}
           FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY year DESC) AS rn FROM y) z
           WHERE rn = 1)
  SELECT s.s_suppkey AS _id, CAST(coalesce(t.n, 0) AS INTEGER) AS n_years, last.last_year,
         {', '.join(f"CASE WHEN t.n >= 2 THEN t.s_{m} / (t.n - 1) ELSE 0.0 END AS trend_{m}" for m in SERIES_METRICS)},
         {', '.join(f"last.l_{m}" for m in SERIES_METRICS)}
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN t ON s.s_suppkey = t.l_suppkey LEFT JOIN last ON s.s_suppkey = last.l_suppkey
"""


@query("trend_per_series", f"""
  SELECT _id, n_years, {', '.join(f"{sql.sround('trend_' + m, 6)} AS trend_{m}" for m in SERIES_METRICS)}
  FROM ({TRENDS}) q
""")
def trend_per_series(spark, d):
    """Mean consecutive change of each yearly metric per supplier."""
    return rounded(series_trends(docs.price_docs(spark, d)), 6)


PROJECT_TO = 2005


@query("project_years", f"""
  WITH RECURSIVE base AS ({TRENDS}),
  proj(_id, year, {', '.join(SERIES_METRICS)}, {', '.join(f"t_{m}" for m in SERIES_METRICS)}) AS (
    SELECT _id, last_year + 1,
           {', '.join(f"greatest(0.0, {sql.sbround(f'l_{m} + trend_{m}', 1)})" for m in SERIES_METRICS)},
           {', '.join(f"trend_{m}" for m in SERIES_METRICS)}
    FROM base WHERE last_year IS NOT NULL AND last_year < {PROJECT_TO}
    UNION ALL
    SELECT _id, year + 1,
           {', '.join(f"greatest(0.0, {sql.sbround(f'{m} + t_{m}', 1)})" for m in SERIES_METRICS)},
           {', '.join(f"t_{m}" for m in SERIES_METRICS)}
    FROM proj WHERE year < {PROJECT_TO})
  SELECT _id, year, {', '.join(SERIES_METRICS)},
         CAST(NULL AS DOUBLE) AS diffAmount, CAST(NULL AS DOUBLE) AS diffPerMeter
  FROM proj
""")
def project_years(spark, d):
    """Y2/Y5/A8/U2 without noise: deterministic projection to 2005."""
    return projected_rows(docs.price_docs(spark, d), end_year=PROJECT_TO, variance=0.0,
                          secondary_threshold=1.0)


@query("extended_history_jsonl", f"""
  WITH RECURSIVE base AS ({TRENDS}),
  proj(_id, year, {', '.join(SERIES_METRICS)}, {', '.join(f"t_{m}" for m in SERIES_METRICS)}) AS (
    SELECT _id, last_year + 1,
           {', '.join(f"greatest(0.0, {sql.sbround(f'l_{m} + trend_{m}', 1)})" for m in SERIES_METRICS)},
           {', '.join(f"trend_{m}" for m in SERIES_METRICS)}
    FROM base WHERE last_year IS NOT NULL AND last_year < {PROJECT_TO}
    UNION ALL
    SELECT _id, year + 1,
           {', '.join(f"greatest(0.0, {sql.sbround(f'{m} + t_{m}', 1)})" for m in SERIES_METRICS)},
           {', '.join(f"t_{m}" for m in SERIES_METRICS)}
    FROM proj WHERE year < {PROJECT_TO})
  SELECT _id, year, {', '.join(SERIES_METRICS)} FROM proj
  UNION ALL
  SELECT s.s_suppkey AS _id, y.year, {', '.join(f"y.{m}" for m in SERIES_METRICS)}
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN ({YEARLY}) y ON s.s_suppkey = y.l_suppkey
""")
def extended_history_jsonl(spark, d):
    """U2 + K8 + S10: histories extended to 2005 (no noise), written as JSON
    Lines, scanned back with the document schema and flattened."""
    ext = extend_history(docs.price_docs(spark, d), end_year=PROJECT_TO, variance=0.0,
                         secondary_threshold=1.0)
    path = scratch_path(spark, "extended-history")
    write_jsonl(ext, path)
    back = read_jsonl(spark, path, ext.schema)
    return back.select("_id", F.explode("info").alias("e")).select(
        "_id", "e.year", *[F.col(f"e.{m}").alias(m) for m in SERIES_METRICS])


def _u(key: str, year: str, tag: str, seed: int = 42) -> str:
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), CAST({year} AS VARCHAR), "
            f"'{tag}', '{seed}')), 1, 8)) AS BIGINT) / 4294967296.0)")


def _noisy(prev: str, trend: str, key: str, year: str, tag: str) -> str:
    v = f"({prev} + {trend})"
    return sql.sbround(f"{v} + {v} * 0.15 * ({_u(key, year, tag)} - 0.5)", 1)


def _secondary(noisy: str, key: str, year: str, tag: str) -> str:
    x = f"({noisy} * 1.1)"
    return (f"CASE WHEN {_u(key, year, 'secondary')} > 0.3 THEN "
            f"{sql.sbround(sql.sbround(f'{x} + {x} * 0.2 * ({_u(key, year, tag)} - 0.5)', 1), 1)} END")


def _noisy_step(src: str, year: str) -> str:
    """SELECT list of one projection year from ``src`` columns (prev values)."""
    def noisy(m: str) -> str:
        return _noisy(src.format(m=m), f"t_{m}", "_id", year, m)

    cols = [f"greatest(0.0, {noisy(m)}) AS {m}" for m in SERIES_METRICS]
    for secondary, primary in (("diffAmount", "Amount"), ("diffPerMeter", "PerMeter")):
        cols.append(f"{_secondary(noisy(primary), '_id', year, secondary)} AS {secondary}")
    return ", ".join(cols)


NOISY_TO = 2025


@query("project_years_noisy", f"""
  WITH RECURSIVE base AS (
    SELECT _id, last_year, {', '.join(f"l_{m}, trend_{m} AS t_{m}" for m in SERIES_METRICS)} FROM ({TRENDS}) q),
  proj(_id, year, {', '.join(SERIES_METRICS)}, diffAmount, diffPerMeter, {', '.join(f"t_{m}" for m in SERIES_METRICS)}) AS (
    SELECT _id, last_year + 1, {_noisy_step("l_{m}", "last_year + 1")},
           {', '.join(f"t_{m}" for m in SERIES_METRICS)}
    FROM base WHERE last_year IS NOT NULL AND last_year < {NOISY_TO}
    UNION ALL
    SELECT _id, year + 1, {_noisy_step("{m}", "year + 1")},
           {', '.join(f"t_{m}" for m in SERIES_METRICS)}
    FROM proj WHERE year < {NOISY_TO})
  SELECT _id, year, {', '.join(SERIES_METRICS)}, diffAmount, diffPerMeter FROM proj
""")
def project_years_noisy(spark, d):
    """Projection to 2025 with +-7.5% noise and 70% secondary metrics."""
    return projected_rows(docs.price_docs(spark, d))


def _catalog(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"),
                                         F.substring("o_orderpriority", 1, 1).alias("p")).distinct()
    fmt = (F.when(F.col("p") == "1", "csv").when(F.col("p") == "2", "CSV").when(F.col("p") == "3", "JSON")
            .when(F.col("p") == "5", "Csv"))
    return o.select(
        F.concat_ws("-", "y", "p").alias("id"), fmt.alias("format"),
        F.concat(F.lit("files/incidents/"), F.col("y").cast("string"), F.lit("/priority_"), F.col("p"),
                 F.lit("."), F.lower(F.coalesce(fmt, F.lit("bin")))).alias("url"),
        F.concat(F.lit("Incidents "), F.col("y").cast("string"), F.lit(" priority "), F.col("p")).alias("name"),
        F.col("y").alias("dataset"), F.col("p").cast("int").alias("position"))


CATALOG_SQL = """
  SELECT concat_ws('-', y, p) AS id, fmt AS format,
         'files/incidents/' || y || '/priority_' || p || '.' || lower(coalesce(fmt, 'bin')) AS url,
         'Incidents ' || y || ' priority ' || p AS name, y AS dataset, CAST(p AS INTEGER) AS position
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, substring(o_orderpriority, 1, 1) AS p,
               CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'csv' WHEN '2' THEN 'CSV'
                    WHEN '3' THEN 'JSON' WHEN '5' THEN 'Csv' END AS fmt
        FROM orders) q
"""

RES_YEAR_SQL = ("coalesce(TRY_CAST(nullif(regexp_extract(url || ' ' || name, '(20\\d{2})', 1), '') "
                "AS INTEGER), 0)")


@query("year_from_url_catalog", f"""
  SELECT id, format, url, name, {RES_YEAR_SQL} AS year FROM ({CATALOG_SQL}) c
""")
def year_from_url_catalog(spark, d):
    """S11 regex: dataset year from "<url> <name>", 0 when no 20xx year."""
    c = _catalog(spark, d)
    return c.select("id", "format", "url", "name", resource_year("url", "name").alias("year"))


@query("plan_downloads", f"""
  SELECT * FROM (
    SELECT id, format, url, name, dataset, position, {RES_YEAR_SQL} AS year
    FROM ({CATALOG_SQL}) c WHERE upper(format) = 'CSV'
    ORDER BY year DESC, url LIMIT 4) q
  WHERE year <> 0
""")
def plan_downloads(spark, d):
    """The four newest CSV resources, year-0 resources skipped."""
    return plan_resources(_catalog(spark, d), limit=4)


@query("first_resource", f"""
  SELECT dataset, arg_min(id, position) AS resource_id FROM ({CATALOG_SQL}) c
  WHERE upper(format) IN ('CSV', 'JSON') GROUP BY 1
""")
def first_resource_query(spark, d):
    """per dataset, the first CSV/JSON resource by position."""
    return first_resource(_catalog(spark, d), "dataset", "position")


@query("partitioned_roundtrip", sql.round_cols(sql.UNIFIED, [
        "average_antiquity_cultural_sites", "average_price_per_square_meter"]))
def partitioned_roundtrip(spark, d):
    """The unified model written partitioned by year, read back."""
    path = scratch_path(spark, "exploitation")
    write_partitioned(ay.unified(spark, d), path, "year")
    back = spark.read.parquet(path)
    return rounded(back.select(*[c for c in back.columns if c != "year"], F.col("year").cast("int")))


@query("index_categories", """
  WITH f AS (SELECT n.n_name, count(*) AS cnt FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
             GROUP BY 1),
  ix AS (SELECT n_name, CAST(row_number() OVER (ORDER BY cnt DESC, n_name) - 1 AS DOUBLE) AS neighborhood_index
         FROM f)
  SELECT c.c_custkey, n.n_name, ix.neighborhood_index
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN ix ON ix.n_name = n.n_name
""")
def index_categories(spark, d):
    """M2: frequency index of each customer's nation (ties alphabetical)."""
    from pyspark.ml.feature import StringIndexer
    c = table(spark, d, "customer").join(table(spark, d, "nation"),
                                         F.col("c_nationkey") == F.col("n_nationkey"))
    idx = StringIndexer(inputCol="n_name", outputCol="neighborhood_index", handleInvalid="keep",
                        stringOrderType="frequencyDesc").fit(c)
    return idx.transform(c).select("c_custkey", "n_name", "neighborhood_index")


def _z(c: str) -> str:
    z = (f"CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 "
         f"ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END")
    return f"{sql.sround(z, 4)} AS z_{c}"


@query("standardize_features", f"""
  WITH u AS ({sql.UNIFIED}),
  ix AS (SELECT neighborhood_name, CAST(row_number() OVER (ORDER BY cnt DESC, neighborhood_name) - 1 AS DOUBLE)
                AS neighborhood_index
         FROM (SELECT neighborhood_name, count(*) AS cnt FROM u GROUP BY 1) f),
  v AS (SELECT u.*, ix.neighborhood_index FROM u JOIN ix USING (neighborhood_name))
  SELECT neighborhood_name, year, {', '.join(_z(c) for c in FEATURES)} FROM v
""")
def standardize_features(spark, d):
    """M3/M4: the nine model features of the unified table, standardized."""
    u = ay.unified(spark, d).checkpoint(eager=True)     # fits + transform read it once
    model = feature_prep().fit(u)
    arr = vector_to_array(F.col("features"))
    out = model.transform(u).select("neighborhood_name", "year",
                                    *[arr[i].alias(f"z_{c}") for i, c in enumerate(FEATURES)])
    return rounded(out)


@query("stable_split", f"""
  SELECT neighborhood_name, year,
         CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', neighborhood_name, CAST(year AS VARCHAR), '42')), 1, 8))
                        AS BIGINT) % 10000 < 7000 THEN 'train' ELSE 'validation' END AS split
  FROM ({sql.UNIFIED}) u
""")
def stable_split_query(spark, d):
    """M6: train/validation membership of each area x year row (key hash)."""
    return with_split(ay.unified(spark, d), ["neighborhood_name", "year"]).select(
        "neighborhood_name", "year", "split")


def _board(spark, d, families):
    results = [ml.tuned(spark, d, f) for f in families]
    return leaderboard(spark, [r for r, _ in results], {r.family: p for r, p in results})


@query("tune_logistic")
def tune_logistic(spark, d):
    """M7 + M10-M13: multinomial logistic regression, 9-point grid, 3 folds."""
    return _board(spark, d, ["logistic_regression"])


@query("tune_forest")
def tune_forest(spark, d):
    """M8: random forest, 6-point grid, 3 folds."""
    return _board(spark, d, ["random_forest"])


@query("tune_tree")
def tune_tree(spark, d):
    """M9: decision tree, 4-point grid, 3 folds."""
    return _board(spark, d, ["decision_tree"])


@query("model_leaderboard")
def model_leaderboard(spark, d):
    """All three families registered with versions."""
    board = _board(spark, d, list(TRAIN_ORDER))
    return register(spark, board, scratch_path(spark, "registry"))


@query("model_report")
def model_report(spark, d):
    """S9 + F7/O3/A6 + A9: the leaderboard written as a results CSV, scanned
    back, ranked by accuracy with the chart domain, and pivoted wide."""
    board = _board(spark, d, list(TRAIN_ORDER))
    path = scratch_path(spark, "results-csv")
    board.select("model", "metric", "value", "training_time").write.option("header", "true").csv(path)
    results = read_csv(spark, path, schema="model string, metric string, value double, training_time double")
    return accuracy_report(results).join(metrics_wide(results), "model")


@query("champion_score")
def champion_score(spark, d):
    """O2 + K6 + L2: the champion pipeline, reloaded, scores held-out orders."""
    board = _board(spark, d, list(TRAIN_ORDER))
    best = champion(board).first()
    _, validation = stable_split(ml.order_frame(spark, d), ml.CELL)
    scored = score(best["path"], validation)
    return scored.select("o_orderkey", "neighborhood_name", "year",
                         F.col("prediction").alias("predicted_class"),
                         F.lit(best["model"]).alias("model"))
