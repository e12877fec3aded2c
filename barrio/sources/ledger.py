"""The processed-file ledger and the download plan.

The ledger is a small append-only table (path, mtime, last_year, ...).
It is appended only after the data write succeeded; an unreadable ledger
counts as empty, so a crash at worst reprocesses files, which the keyed
upsert makes harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from barrio.functions.keys import resource_year

LEDGER_SCHEMA = ("path string, mtime timestamp, last_year int, rows bigint, "
                 "status string, processed_at timestamp")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one when it is missing or unreadable (then
    every file is processed again -- harmless behind the keyed upsert)."""
    try:
        df = spark.read.schema(LEDGER_SCHEMA).parquet(path)
        df.limit(1).collect()
        return df
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    except Exception:  # noqa: BLE001 -- a torn or foreign file: start over
        return spark.createDataFrame([], LEDGER_SCHEMA)


def append_ledger(entries: DataFrame, path: str) -> None:
    entries.selectExpr(*[c.split(" ")[0] for c in LEDGER_SCHEMA.split(", ")]) \
        .write.mode("append").parquet(path)


def pending_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """files not in the ledger, or modified since they were recorded.

    Keyed by full path, so equal base names in two folders do not collide.
    """
    seen = ledger.groupBy("path").agg(F.max("mtime").alias("seen_mtime"),
                                      F.max_by("last_year", "mtime").alias("last_year"))
    return (listing.join(seen, "path", "left")
                   .filter(F.col("seen_mtime").isNull()
                           | (F.col("modificationTime") > F.col("seen_mtime"))))


def plan_resources(catalog: DataFrame, landed_years: DataFrame | None = None,
                   limit: int | None = None) -> DataFrame:
    """F4 + O1 + F5: which CSV resources to fetch.

    CSV resources (format compared case-insensitively), newest year first
    (url breaks ties), optionally the first ``limit`` of them; then year-0
    resources (no 20xx year in url or name) and years already landed are
    skipped -- the cut applies to resources, before the skips.
    """
    csv = (catalog.withColumn("year", resource_year("url", "name"))
                  .filter(F.upper(F.col("format")) == "CSV"))
    if limit is not None:
        csv = csv.orderBy(F.desc("year"), F.asc("url")).limit(limit)
    todo = csv.filter(F.col("year") != 0)
    if landed_years is not None:
        todo = todo.join(landed_years.select("year").distinct(), "year", "left_anti")
    return todo


def first_resource(catalog: DataFrame, dataset: str | Column, position: str | Column,
                   formats: tuple[str, ...] = ("CSV", "JSON")) -> DataFrame:
    """per dataset, the first resource (by position) in one of ``formats``."""
    ds = F.col(dataset) if isinstance(dataset, str) else dataset
    pos = F.col(position) if isinstance(position, str) else position
    return (catalog.filter(F.upper(F.col("format")).isin(*formats))
                   .groupBy(ds.alias("dataset"))
                   .agg(F.min_by("id", pos).alias("resource_id")))
