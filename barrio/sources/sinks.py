"""Landing and lakehouse sinks.  No ``coalesce(1)``: writers stay parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.functions.casts import quoted

# Text sinks keep microseconds (the default writer pattern stops at millis).
TEXT_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_writer(df: DataFrame):
    """``df.write`` preconfigured for lossless JSON/CSV timestamps."""
    return df.write.options(**TEXT_WRITE_OPTIONS)


def land_json(df: DataFrame, path: str, batch_id: str, batch_col: str = "ingest_batch") -> None:
    """K1: append one landing batch as JSON Lines under ``<batch_col>=<id>``."""
    json_writer(df.withColumn(batch_col, F.lit(batch_id))).mode("append").partitionBy(batch_col).json(path)


def land_csv_by_year(df: DataFrame, path: str, year_col: str = "year") -> None:
    """K2: header CSV per year; re-landing a year replaces only that year.
    Rebalanced by year: a few files per year, not one per task and year."""
    (json_writer(df.hint("rebalance", year_col)).mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("header", "true").partitionBy(year_col).csv(path))


def replace_snapshot(df: DataFrame, path: str, fmt: str = "json") -> None:
    """K3: the folder holds exactly the latest snapshot."""
    json_writer(df).mode("overwrite").format(fmt).save(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """K8: JSON Lines out (one record per line, nested arrays kept)."""
    json_writer(df).mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, partition_col: str = "year",
                      files_per_partition: int = 1, max_records_per_file: int = 5_000_000) -> None:
    """K5: overwrite a table partitioned by ``partition_col``.

    By default rows are *rebalanced* by the partition column: one writer per
    value instead of one small file per task, and AQE splits a skewed value
    (a hot year) over several writers and merges tiny ones.  With
    ``files_per_partition > 1`` rows are clustered by (value, hash bucket)
    explicitly, giving up to that many files per value.  Plain overwrite
    replaces the schema too.
    """
    if files_per_partition > 1:
        bucket = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]), F.lit(files_per_partition))
        clustered = df.repartition(F.col(quoted(partition_col)), bucket)
    else:
        clustered = df.hint("rebalance", partition_col)
    (clustered.write.mode("overwrite")
       .option("partitionOverwriteMode", "static")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(partition_col).parquet(path))
