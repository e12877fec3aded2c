"""Batch incremental load of landed JSON files.

listing (S6) -> anti-join with the ledger (F2) -> read only those files
-> keyed upsert (K4) -> ledger append (K7).  The pending file list is
metadata (one entry per new file); the rows never leave the executors.
Within one run the newest file wins for a key: the version is the file's
modification time, then its path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barrio.session import scratch_path
from barrio.sources.files import list_files, read_jsonl
from barrio.sources.ledger import LEDGER_SCHEMA, append_ledger, pending_files, read_ledger
from barrio.sources.upsert import upsert


def incremental_load(spark: SparkSession, landing: str, ledger_path: str, table_path: str,
                     schema: StructType, keys: Sequence[str],
                     version: Sequence[Column | str] | None = None,
                     partition_col: str | None = None, year_col: str | None = "year",
                     pattern: str = "*.json", key_buckets: int | None = None, changes: bool = False) -> DataFrame:
    """Process new or modified files; returns the ledger rows it appended.
    ``changes`` keeps the rows that came and went (``operators.maintain``)."""
    todo = pending_files(list_files(spark, landing, pattern), read_ledger(spark, ledger_path))
    files = todo.select("path", "modificationTime").orderBy("path").collect()
    if not files:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    batch = (read_jsonl(spark, [f["path"] for f in files], schema)
             .withColumn("_src_path", F.col("_metadata.file_path"))
             .withColumn("_src_mtime", F.col("_metadata.file_modification_time")))
    # one parse of the raw files (upsert + stats); columnar, as each row names its file
    parsed = scratch_path(spark, "parsed")
    batch.write.parquet(parsed)
    batch = spark.read.schema(batch.schema).parquet(parsed)
    upsert(spark, batch, table_path, keys,
           version or [F.col("_src_mtime"), F.col("_src_path")], partition_col, key_buckets, changes)
    last = F.max(year_col).cast("int") if year_col else F.lit(None).cast("int")
    stats = (batch.groupBy(F.col("_src_path").alias("path"))
             .agg(F.count(F.lit(1)).alias("rows"), last.alias("last_year")))
    listed = spark.createDataFrame([(f["path"], f["modificationTime"]) for f in files],
                                   "path string, mtime timestamp")
    entries = (listed.join(stats, "path", "left")
               .select("path", "mtime", "last_year", F.coalesce("rows", F.lit(0)).alias("rows"),
                       F.lit("ok").alias("status"), F.current_timestamp().alias("processed_at")))
    append_ledger(entries, ledger_path)
    return read_ledger(spark, ledger_path).join(listed, ["path", "mtime"], "left_semi")
