"""Landing, scanning, ledger, upsert and streaming queries.

Each query writes what it needs under a fresh folder of the shared
scratch root (``spark.checkpoint.dir``) and returns a DataFrame that reads
it back, so the oracle can compare the round trip with the source table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barrio.operators.normalize import INCIDENT_TYPES, union_flexible
from barrio.operators.quality import read_json_checked, run_report
from barrio.operators.ranks import numbered
from barrio.plans.area_year import VICTIM_UNIT
from barrio.plans.catalog import query
from barrio.plans.tables import table
from barrio.session import scratch_path
from barrio.sources.files import read_drifting_csv, read_jsonl
from barrio.sources.sinks import json_writer, land_csv_by_year, land_json, replace_snapshot
from barrio.sources.upsert import upsert
from barrio.sources.versioned import read_table
from barrio.streaming import events, rewritten
from barrio.streaming.incremental import incremental_load
from barrio.streaming.stream import stream_upsert

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
YEAR_SQL = "CAST(year(o_orderdate) AS INTEGER)"


def _orders_with_year(spark, d):
    o = table(spark, d, "orders")
    return o, o.withColumn("year", F.year("o_orderdate"))


@query("land_and_rescan", "SELECT * FROM orders")
def land_and_rescan(spark, d):
    """K1 + S1: land orders as a JSON Lines batch, scan it back typed."""
    o = table(spark, d, "orders")
    path = scratch_path(spark, "landing-orders-json")
    land_json(o, path, "b1")
    return read_jsonl(spark, path, o.schema).select(*o.columns)


@query("land_csv_by_year", f"SELECT *, {YEAR_SQL} AS year FROM orders")
def land_csv_by_year_query(spark, d):
    """K2 + S3: land orders as header CSV per year, scan back with the schema."""
    o, oy = _orders_with_year(spark, d)
    path = scratch_path(spark, "landing-orders-csv")
    land_csv_by_year(oy, path)
    back = spark.read.schema(o.schema).option("header", "true").csv(path)
    return back.select(*o.columns, F.col("year").cast("int").alias("year"))


@query("land_snapshot", "SELECT * FROM customer")
def land_snapshot(spark, d):
    """K3: a newer snapshot replaces the older one entirely."""
    c = table(spark, d, "customer")
    path = scratch_path(spark, "landing-sites")
    replace_snapshot(c.filter(F.col("c_mktsegment") == "BUILDING"), path)
    replace_snapshot(c, path)
    return read_jsonl(spark, path, c.schema)


def _victims():
    return F.nullif(F.floor(F.col("o_totalprice") / VICTIM_UNIT), F.lit(0)).cast("bigint")


@query("delimiter_sniff_scan", f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS expedient_id, {YEAR_SQL} AS year,
         CAST(NULL AS INTEGER) AS district_id, CAST(NULL AS VARCHAR) AS district_name,
         CAST(o_custkey AS INTEGER) AS neighborhood_id, o_orderpriority AS neighborhood_name,
         CAST(nullif(floor(o_totalprice / 100000.0), 0) AS BIGINT) AS num_victims,
         CAST(NULL AS BIGINT) AS num_deaths, CAST(NULL AS BIGINT) AS num_minor_injuries,
         CAST(NULL AS BIGINT) AS num_serious_injuries
  FROM orders
""")
def delimiter_sniff_scan(spark, d):
    """Three yearly layouts (`,` UTF-8; `;` ISO-8859-1 with
    accented headers; no year column, Hive year folders), sniffed per file
    and read per variant."""
    _, o = _orders_with_year(spark, d)
    root = scratch_path(spark, "landing-incidents")
    (o.filter(F.col("year") <= 1997)
      .select(F.col("o_orderkey").alias("Numero_expedient"), F.col("o_custkey").alias("Codi_barri"),
              F.col("o_orderpriority").alias("Nom_barri"), F.col("year").alias("NK_Any"),
              _victims().alias("Numero_victimes"))
      .write.option("header", "true").csv(f"{root}/a"))
    (o.filter(F.col("year").between(1998, 1999))
      .select(F.col("o_orderkey").alias("Número d'expedient"), F.col("o_custkey").alias("Codi barri"),
              F.col("o_orderpriority").alias("Nom barri"), F.col("year").alias("NK Any"),
              _victims().alias("Numero_victimes"))
      .write.option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1")
      .csv(f"{root}/b"))
    (o.filter(F.col("year") >= 2000)
      .select(F.col("o_orderkey").alias("Numero_expedient"), F.col("o_orderpriority").alias("Nom_barri"),
              F.col("o_custkey").alias("Codi_barri"), _victims().alias("Numero_victimes"), "year")
      .write.option("header", "true").partitionBy("year").csv(f"{root}/c"))
    res = read_drifting_csv(spark, root, name_pattern=None, folder_pattern=r"year=(\d{4})")
    return res.data.select(*INCIDENT_TYPES.keys())


@query("quarantine_report", """
  SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing' ELSE 'ok' END AS status,
         CASE WHEN event_type = 'signup' THEN 'missing event_id' END AS reason,
         CAST(count(*) AS BIGINT) AS rows
  FROM events GROUP BY 1, 2
""")
def quarantine_report(spark, d):
    """Q1/Q3: events landed with broken lines ('error' rows truncated) and
    records without their id ('signup' rows); nothing stops, all is counted."""
    e = table(spark, d, "events")
    full = F.to_json(F.struct(*e.columns))
    no_id = F.to_json(F.struct(*[c for c in e.columns if c != "event_id"]))
    line = (F.when(F.col("event_type") == "error", F.substring(full, 1, 25))
             .when(F.col("event_type") == "signup", no_id)
             .otherwise(full))
    path = scratch_path(spark, "landing-events")
    e.select(line.alias("value")).write.text(path)
    checked = read_json_checked(spark, path, e.schema, required=["event_id"])
    return run_report(checked)


@query("incremental_files", f"SELECT *, {YEAR_SQL} AS year FROM orders")
def incremental_files(spark, d):
    """Two landed drops, three runs (the last finds nothing)."""
    o, oy = _orders_with_year(spark, d)
    root = scratch_path(spark, "incremental")
    schema = StructType(list(oy.schema.fields))
    json_writer(oy.filter(F.col("year") <= 1998)).json(f"{root}/landing/drop1")
    args = (spark, f"{root}/landing", f"{root}/ledger", f"{root}/table", schema, ["o_orderkey"])
    incremental_load(*args, partition_col="year")
    json_writer(oy.filter(F.col("year") >= 1999)).json(f"{root}/landing/drop2")
    incremental_load(*args, partition_col="year")
    incremental_load(*args, partition_col="year")
    return read_table(spark, f"{root}/table").select(*o.columns, "year")


@query("upsert_last_write_wins", f"""
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority, {YEAR_SQL} AS year,
         CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS version
  FROM orders
""")
def upsert_last_write_wins(spark, d):
    """A second batch re-states open orders; the newer version wins
    and only the (year, key bucket) partitions it touches are rewritten."""
    o, oy = _orders_with_year(spark, d)
    path = scratch_path(spark, "upsert-orders")
    upsert(spark, oy.withColumn("version", F.lit(1)), path, ["o_orderkey"], ["version"], "year",
           key_buckets=4)
    b2 = (oy.filter(F.col("o_orderstatus") == "O")
            .withColumn("o_totalprice", F.col("o_totalprice") * 2)
            .withColumn("version", F.lit(2)))
    upsert(spark, b2, path, ["o_orderkey"], ["version"], "year", key_buckets=4)
    return read_table(spark, path).select(*o.columns, "year", "version")


@query("union_flexible_schema", """
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
         o_totalprice,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS o_orderdate,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
  FROM orders
""")
def union_flexible_schema(spark, d):
    """Two yearly layouts (one stores the price as text) unioned by name."""
    o = table(spark, d, "orders")
    a = o.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("string").alias("o_totalprice"))
    b = o.filter(F.col("o_orderstatus") != "F").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    return union_flexible([a, b], {"o_totalprice": "double"})


@query("stream_upsert", """
  SELECT user_id, event_id, ts, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) q
  WHERE rn = 1
""")
def stream_upsert_query(spark, d):
    """Events land as JSON in two drops; an availableNow stream upserts
    the latest event per user after each drop."""
    e = table(spark, d, "events")
    root = scratch_path(spark, "stream-events")
    schema = StructType(list(e.schema.fields))
    first = F.col("event_type").isin("view", "click")
    args = dict(spark=spark, source_dir=f"{root}/src/*", schema=schema, table_path=f"{root}/table",
                keys=["user_id"], version=["ts", "event_id"], checkpoint=f"{root}/ckpt")
    json_writer(e.filter(first)).json(f"{root}/src/drop1")
    stream_upsert(**args)
    json_writer(e.filter(~first)).json(f"{root}/src/drop2")
    stream_upsert(**args)
    return read_table(spark, f"{root}/table").select(
        "user_id", "event_id", "ts", "event_type", "value", "props")


EVENT_DELAY = "6 hours"


@query("late_events", """
  WITH e AS (SELECT event_id, user_id, ts, event_type, value, row_number() OVER (ORDER BY ts, event_id) AS n,
                    count(*) OVER () AS total FROM events),
  d AS (
    SELECT *, CASE WHEN event_id % 7 = 0 THEN 3 WHEN event_id % 11 = 0 THEN 2 ELSE CAST(ceil(3.0 * n / total) AS INTEGER) END AS drop_no FROM e
    UNION ALL SELECT *, 3 AS drop_no FROM e WHERE event_id % 5 = 0 AND event_id % 7 <> 0),
  marks AS (SELECT drop_no, max(epoch_ms(ts)) AS top FROM d GROUP BY drop_no),
  j AS (SELECT d.*, coalesce((SELECT max(top) FROM marks m WHERE m.drop_no < d.drop_no) - 6 * 3600 * 1000, 0) AS mark FROM d),
  v AS (SELECT *, epoch_ms(ts) < mark AS late FROM j)
  SELECT event_id, user_id, event_type, value,
         CASE WHEN late THEN 'late' WHEN row_number() OVER (PARTITION BY event_id, late ORDER BY drop_no) = 1 THEN 'kept'
              ELSE 'duplicate' END AS status
  FROM v
""")
def late_events(spark, d):
    """Events are delivered in three drops by time, some of them too late or
    once more; a stream with a watermark keeps, sets aside or drops each."""
    e = table(spark, d, "events").select(
        "event_id", "user_id", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("ts"),
        "event_type", "value")
    # which third of the time order an event lies in
    third = F.ceil(3 * F.col("n") / F.col("total")).cast("int")
    first = numbered(e, ["ts", "event_id"]).withColumn(
        "drop_no", F.when(F.col("event_id") % 7 == 0, 3).when(F.col("event_id") % 11 == 0, 2).otherwise(third)).drop("n", "total")
    again = e.where((F.col("event_id") % 5 == 0) & (F.col("event_id") % 7 != 0)).withColumn("drop_no", F.lit(3))
    rows = first.unionByName(again)
    root = scratch_path(spark, "late-events")
    for n in (1, 2, 3):
        json_writer(rows.where(F.col("drop_no") == n).drop("drop_no")).json(f"{root}/src/drop{n}")
        events.judge_files(spark, f"{root}/src/*", e.schema, f"{root}/out", ["event_id"], "ts", EVENT_DELAY, f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out").select(
        "event_id", "user_id", "event_type", "value", F.col(events.STATUS).alias("status"))


@query("rewritten_files", f"""
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN year(o_orderdate) < 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority, {YEAR_SQL} AS year
  FROM orders
""")
def rewritten_files(spark, d):
    """A stream upserts what has landed; files of the early years are then
    rewritten in place and are upserted once more, the others are not."""
    o, oy = _orders_with_year(spark, d)
    root = scratch_path(spark, "rewritten")
    schema = StructType(list(oy.schema.fields))
    args = (spark, f"{root}/src", schema, f"{root}/table", ["o_orderkey"], f"{root}/ckpt")

    def land(rows):
        # the same folder for the same years: a snapshot replaces its files
        json_writer(rows.withColumn("part", F.when(F.col("year") < 1998, "early").otherwise("late")))\
            .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").json(f"{root}/src")

    land(oy)
    rewritten.stream_changed_files(*args, partition_col="year")
    land(oy.where(F.col("year") < 1998).withColumn("o_totalprice", F.col("o_totalprice") + 1))
    rewritten.stream_changed_files(*args, partition_col="year")
    return read_table(spark, f"{root}/table").select(*o.columns, "year")
