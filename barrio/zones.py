"""The zones end to end: landing files -> formatted tables -> exploitation.

Stage functions with the shape of the source jobs' public surface,
each an incremental Spark job over folders:

    format_price_files     landing JSON Lines price histories -> formatted prices
    format_incident_files  landing yearly CSV (drifting layouts) -> formatted incidents
    format_site_files      landing site documents -> formatted sites
    build_exploitation     three formatted tables -> unified table partitioned by year
    extend_history_files   price histories -> histories projected to a target year

Every format stage: list files (S6) -> anti-join the ledger (F2) -> read
only those files -> flatten / map / dedupe -> checkpoint the batch once
(the upsert, its empty probe and the per-file ledger stats all read it: one
parse of the raw files, T7) -> keyed upsert (K4) -> append the ledger (K7)
after the write.  Within and across runs the newest file
wins for a key (version = file modification time, then path).  Each stage
returns the ledger rows it appended (file, rows, last year, status).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.operators.aggregates import avg_price, incident_totals, site_totals
from barrio.operators.dedupe import latest
from barrio.operators.forecast import extend_history
from barrio.operators.nested import format_prices, format_sites
from barrio.operators.unify import unified_model
from barrio.sources.files import list_files, read_drifting_csv, read_json_documents, read_jsonl
from barrio.sources.ledger import LEDGER_SCHEMA, append_ledger, pending_files, read_ledger
from barrio.sources.sinks import write_jsonl, write_partitioned
from barrio.sources.upsert import upsert
from barrio.sources.versioned import read_table, table_or_none

PRICE_DOC_SCHEMA = (
    "_id bigint, district_id bigint, district_name string, `neigh_name ` string, neigh_name string, "
    "info array<struct<year: bigint, PerMeter: double, Amount: double, usedAmount: double, "
    "usedPerMeter: double, diffAmount: double, diffPerMeter: double>>")
SITE_DOC_SCHEMA = (
    "register_id string, name string, created string, addresses_neighborhood_name string, "
    "addresses array<struct<neighborhood_name: string>>")
VERSION = ["_src_mtime", "_src_path"]
CORRUPT = "_corrupt_record"
# partitions (by key hash) of a formatted table without a year: a drop rewrites
# those its keys fall in.  A table keeps the number it was made with.
KEY_BUCKETS = 8


def _pending(spark: SparkSession, landing: str, ledger: str, pattern: str) -> list:
    """New or modified landing files (metadata only: one entry per file)."""
    todo = pending_files(list_files(spark, landing, pattern), read_ledger(spark, ledger))
    return todo.select("path", "modificationTime").orderBy("path").collect()


def _record(spark: SparkSession, files: list, stats: DataFrame, ledger: str,
            status: DataFrame | None = None) -> DataFrame:
    listed = spark.createDataFrame([(f["path"], f["modificationTime"]) for f in files],
                                   "path string, mtime timestamp")
    entries = listed.join(stats, "path", "left")
    st = F.lit("ok")
    if status is not None:
        entries = entries.join(status, "path", "left")
        st = F.coalesce(F.col("status"), st)
    entries = entries.select("path", "mtime", "last_year", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                             st.alias("status"), F.current_timestamp().alias("processed_at"))
    append_ledger(entries, ledger)
    return read_ledger(spark, ledger).join(listed, ["path", "mtime"], "left_semi")


def _with_source(df: DataFrame) -> DataFrame:
    return (df.withColumn("_src_path", F.col("_metadata.file_path"))
              .withColumn("_src_mtime", F.col("_metadata.file_modification_time")))


def _read_lines(spark: SparkSession, paths: list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON Lines with malformed lines set aside (Q1/Q2): returns the good
    rows (with their file of origin) and per-file malformed counts."""
    # parsed once into the checkpoint; good rows and the malformed count
    # both read it (a raw scan may not be queried for the corrupt column alone)
    raw = _with_source(read_jsonl(spark, paths, f"{schema}, {CORRUPT} string", corrupt_col=CORRUPT)) \
        .checkpoint(eager=True)
    bad = (raw.filter(F.col(CORRUPT).isNotNull()).groupBy(F.col("_src_path").alias("path"))
              .agg(F.concat(F.lit("ok, "), F.count(F.lit(1)).cast("string"), F.lit(" malformed lines"))
                   .alias("status")))
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def format_price_files(spark: SparkSession, landing: str, formatted: str, ledger: str,
                       pattern: str = "*.json") -> DataFrame:
    """Prices: JSON Lines histories -> one row per (area id, year), ``_id =
    id-year``.  Watermark per area id (T5): only years after the latest year
    already formatted for that id are taken."""
    files = _pending(spark, landing, ledger, pattern)
    if not files:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    docs, bad = _read_lines(spark, [f["path"] for f in files], PRICE_DOC_SCHEMA)
    docs = docs.withColumn("neigh_name ", F.coalesce(F.col("`neigh_name `"), F.col("neigh_name"))) \
               .drop("neigh_name")
    cur = table_or_none(spark, formatted)
    if cur is not None:
        wm = cur.groupBy("neighborhood_id").agg(F.max("year").alias("_wm"))
        docs = docs.join(wm, docs["_id"].try_cast("int") == wm["neighborhood_id"], "left").drop("neighborhood_id")
        mark = F.coalesce(F.col("_wm"), F.lit(0))
    else:
        mark = F.lit(0)
    flat = format_prices(docs.withColumn("_mark", mark), last_year=F.col("_mark"), keep=tuple(VERSION))
    batch = latest(flat, ["_id"], VERSION).checkpoint(eager=True)
    upsert(spark, batch, formatted, ["_id"], VERSION, "year")
    stats = batch.groupBy(F.col("_src_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("year").alias("last_year"))
    return _record(spark, files, stats, ledger, bad)


def format_incident_files(spark: SparkSession, landing: str, formatted: str, ledger: str,
                          pattern: str = "*.csv", key_buckets: int = KEY_BUCKETS, **csv_options) -> DataFrame:
    """Incidents: yearly CSV files whose layout drifts -> one row per
    ``expedient_id`` (newest file wins); layouts missing the id are
    quarantined and recorded in the ledger with that status."""
    files = _pending(spark, landing, ledger, pattern)
    if not files:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    res = read_drifting_csv(spark, [f["path"] for f in files], pattern=pattern, **csv_options)
    batch = (res.data.filter(F.col("expedient_id").isNotNull())
             .withColumnRenamed("_file_path", "_src_path").withColumnRenamed("_file_mtime", "_src_mtime")
             .drop("_file_name"))
    batch = (latest(batch, ["expedient_id"], VERSION)
             .withColumn("_id", F.col("expedient_id").cast("string"))
             .checkpoint(eager=True))
    upsert(spark, batch, formatted, ["expedient_id"], VERSION, key_buckets=key_buckets)
    stats = batch.groupBy(F.col("_src_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("year").alias("last_year"))
    status = res.report.select(F.col("file_path").alias("path"), "status").filter(F.col("status") != "ok")
    return _record(spark, files, stats, ledger, status)


def format_site_files(spark: SparkSession, landing: str, formatted: str, ledger: str,
                      pattern: str = "*.json", documents: bool = False, key_buckets: int = KEY_BUCKETS) -> DataFrame:
    """Sites: snapshot records -> one row per ``register_id`` (G2 + D2).
    ``documents=True`` reads whole-file JSON arrays instead of JSON Lines."""
    files = _pending(spark, landing, ledger, pattern)
    if not files:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    paths = [f["path"] for f in files]
    if documents:
        raw, bad = _with_source(read_json_documents(spark, paths, SITE_DOC_SCHEMA)), None
    else:
        raw, bad = _read_lines(spark, paths, SITE_DOC_SCHEMA)
    if raw.filter(F.col("addresses").isNotNull()).isEmpty():
        raw = raw.drop("addresses")
    else:
        raw = raw.drop("addresses_neighborhood_name")
    batch = (latest(format_sites(raw), ["register_id"], VERSION)
             .withColumn("_id", F.col("register_id").cast("string"))
             .checkpoint(eager=True))
    upsert(spark, batch, formatted, ["register_id"], VERSION, key_buckets=key_buckets)
    stats = batch.groupBy(F.col("_src_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("int").alias("last_year"))
    return _record(spark, files, stats, ledger, bad)


def build_exploitation(spark: SparkSession, prices: str, incidents: str, sites: str, out: str,
                       as_of: str | dt.date, flags: bool = False) -> DataFrame:
    """J-3 + K5: the unified model over the formatted tables, written
    partitioned by year; returns the written table."""
    u = unified_model(avg_price(read_table(spark, prices)),
                      incident_totals(read_table(spark, incidents)),
                      site_totals(read_table(spark, sites), as_of), flags=flags)
    write_partitioned(u, out, "year")
    return spark.read.parquet(out)


def extend_history_files(spark: SparkSession, source: str, out: str, end_year: int = 2025,
                         **projection) -> DataFrame:
    """Y1-Y5 + S10 + K8: read JSON Lines histories, project every history to
    ``end_year`` and write JSON Lines."""
    docs = read_jsonl(spark, source, PRICE_DOC_SCHEMA)
    docs = docs.withColumn("neigh_name ", F.coalesce(F.col("`neigh_name `"), F.col("neigh_name"))) \
               .drop("neigh_name")
    write_jsonl(extend_history(docs, end_year=end_year, **projection), out)
    return spark.read.json(out)
