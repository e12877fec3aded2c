"""Q1-Q3: quarantine instead of failing, and a run report as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barrio.sources.files import read_jsonl

CORRUPT = "_corrupt_record"


def read_json_checked(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                      required: Sequence[str] = ()) -> DataFrame:
    """JSON Lines with a ``status``/``reason`` per row: ``ok``, ``malformed``
    (unparseable line, raw text kept in ``_corrupt_record``) or ``missing``
    (a required field absent).  Nothing is dropped; filter on ``status``."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    raw = read_jsonl(spark, paths, full, corrupt_col=CORRUPT)
    raw = raw.withColumn("_file", F.col("_metadata.file_path"))
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required]) \
        if required else F.lit("")
    return (raw.withColumn("_missing", missing)
               .withColumn("status", F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
                                      .when(F.col("_missing") != "", F.lit("missing"))
                                      .otherwise(F.lit("ok")))
               .withColumn("reason", F.when(F.col("status") == "missing",
                                            F.concat(F.lit("missing "), F.col("_missing"))))
               .drop("_missing"))


def split_checked(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without bookkeeping columns, quarantined rows)."""
    good = df.filter(F.col("status") == "ok").drop(CORRUPT, "status", "reason", "_file")
    return good, df.filter(F.col("status") != "ok")


def run_report(df: DataFrame, by: Sequence[str] = ("status", "reason")) -> DataFrame:
    """Q3: row counts per outcome (add ``_file`` to ``by`` for per-file)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def observed_write(df: DataFrame, rules: dict[str, Column], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write ``df`` and count, in the same pass, its rows and those that meet
    each rule.  The counts come back with the write itself (Spark's observed
    metrics): nothing is scanned for them."""
    seen = Observation()
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts))
    return seen.get
