"""Scans of landing files: listings, JSON, CSV with drifting layouts.

Only metadata reaches the driver: file listings and one header line per
file, grouped into a handful of (delimiter, encoding, header) variants.
Each variant is read by one Spark job with its own options, normalized at
the schema level and unioned by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barrio.operators.normalize import INCIDENT_HEADERS, INCIDENT_TYPES, conform, header_plan, with_year
from barrio.functions.casts import quoted
from barrio.functions.keys import FILE_NAME_YEAR_PATTERN, FOLDER_YEAR_PATTERN


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of every file under ``root``.

    Only the listing columns are selected, so file contents are not read.
    """
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(root)
            .select("path", "modificationTime", "length"))


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
               corrupt_col: str | None = None) -> DataFrame:
    """JSON Lines with an explicit schema; blank lines are skipped.

    With ``corrupt_col`` malformed lines are kept (PERMISSIVE) with their raw
    text in that column instead of failing the job.
    """
    r = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.json(paths if isinstance(paths, str) else list(paths))


def read_json_documents(spark: SparkSession, paths: str | Sequence[str],
                        schema: StructType | str | None = None) -> DataFrame:
    """Whole-file JSON documents (``multiLine``).  Only for real JSON
    documents -- a JSON Lines file read this way yields its first record."""
    r = spark.read.option("multiLine", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths if isinstance(paths, str) else list(paths))


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None,
             delimiter: str = ",", encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """CSV with header; all strings unless a schema is given (no
    inference pass over the data)."""
    r = (spark.read.option("header", str(header).lower()).option("sep", delimiter)
         .option("encoding", encoding).option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(paths if isinstance(paths, str) else list(paths))


def read_catalog(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Resources of a package-catalog response ``{"result": {"resources": [...]}}``."""
    doc = read_json_documents(spark, paths)
    return doc.select(F.explode("result.resources").alias("r")).select("r.*")


def sniff(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """Per file, its header line, delimiter and encoding, in one job.

    Delimiter: ``;`` when the first line has more ``;`` than ``,`` (ties ->
    ``,``).  Encoding: UTF-8 unless some line of the file is not valid
    UTF-8, then ISO-8859-1.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .text(paths if isinstance(paths, str) else list(paths))
             .select("value", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_pos")))
    first = F.min_by(F.when(F.col("_start") == 0, F.col("value")),
                     F.when(F.col("_start") == 0, F.col("_pos")))
    per_file = lines.groupBy("file_path").agg(
        first.alias("header"),
        F.max((~F.expr("is_valid_utf8(value)")).cast("int")).alias("_bad"))

    def count(ch: str):
        return F.length("header") - F.length(F.replace(F.col("header"), F.lit(ch), F.lit("")))

    return per_file.select(
        "file_path", "header",
        F.when(count(";") > count(","), F.lit(";")).otherwise(F.lit(",")).alias("delimiter"),
        F.when(F.col("_bad") == 1, F.lit("ISO-8859-1")).otherwise(F.lit("UTF-8")).alias("encoding"))


@dataclass
class DriftingRead:
    data: DataFrame          # conformed rows of every accepted file
    report: DataFrame        # one row per file: variant, status, reason, dropped headers


def read_drifting_csv(spark: SparkSession, paths: str | Sequence[str],
                      mapping=INCIDENT_HEADERS, types=INCIDENT_TYPES,
                      required: Sequence[str] = ("expedient_id",),
                      name_pattern: str | None = FILE_NAME_YEAR_PATTERN,
                      folder_pattern: str | None = FOLDER_YEAR_PATTERN,
                      pattern: str = "*.csv") -> DriftingRead:
    """S4 + P3-P7 + Q1: read yearly CSV files whose layout drifts.

    Files are grouped by (delimiter, encoding, header); each group is one
    read, mapped to canonical columns, given a year (column, else file name,
    else folder) and typed.  A group missing a required column is
    quarantined and listed in the report instead of stopping the rest.
    """
    variants = (sniff(spark, paths, pattern)
                .groupBy("delimiter", "encoding", "header")
                .agg(F.sort_array(F.collect_list("file_path")).alias("files"))
                .orderBy("delimiter", "encoding", "header")
                .collect())
    frames, report_rows = [], []
    for i, v in enumerate(variants):
        raw = read_csv(spark, list(v["files"]), delimiter=v["delimiter"], encoding=v["encoding"])
        raw = raw.select("*", F.col("_metadata.file_path").alias("_file_path"),
                         F.col("_metadata.file_name").alias("_file_name"),
                         F.col("_metadata.file_modification_time").alias("_file_mtime"))
        meta = ("_file_path", "_file_name", "_file_mtime")
        plan, dropped = header_plan([c for c in raw.columns if c not in meta], mapping)
        missing = [r for r in required if r not in {t for _, t in plan}]
        for f in v["files"]:
            report_rows.append((f, i, v["delimiter"], v["encoding"],
                                "quarantined" if missing else "ok",
                                ("missing " + ",".join(missing)) if missing else None,
                                ",".join(dropped) or None))
        if missing:
            continue
        df = raw.select(*[F.col(quoted(s)).alias(t) for s, t in plan], *meta)
        df = with_year(df, F.col("_file_name"), F.col("_file_path"),
                       name_pattern=name_pattern, folder_pattern=folder_pattern)
        frames.append(conform(df, types))
    schema = ("file_path string, variant int, delimiter string, encoding string, status string, "
              "reason string, dropped_headers string")
    report = spark.createDataFrame(report_rows, schema)
    if not frames:
        empty = spark.createDataFrame([], ", ".join(f"{quoted(k)} {t}" for k, t in types.items()))
        return DriftingRead(empty, report)
    data = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return DriftingRead(data, report)
