"""Shared-folder tables and input columns of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from barrio.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def col(name: str):
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names."""
    return df.select(*[col(source).alias(own) for own, source in names.items()])


def unused(df: DataFrame, name: str, *others: str) -> str:
    """``name``, with ``_`` added while ``df`` or ``others`` have it (in any case)."""
    taken = {c.lower() for c in (*df.columns, *others)}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` with a function that keeps the columns, whatever their names
    (Spark's own takes no dots): they travel under plain ones."""
    names, plain = df.columns, [f"c{i}" for i in range(len(df.columns))]
    schema = StructType([StructField(p, f.dataType, f.nullable) for p, f in zip(plain, df.schema.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fn(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(plain)
    return df.toDF(*plain).mapInArrow(run, schema).toDF(*names)
