"""Structured Streaming incremental load with a keyed upsert sink.

``readStream`` over a landing folder (new files only, tracked in the
stream checkpoint) -> ``foreachBatch`` keyed upsert.  Re-running a
micro-batch after a failure re-applies the same rows, and last-write-wins
by version makes that idempotent.  A file rewritten in place is *not*
picked up again by the file source; use the batch loader (W1) for those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from barrio.sources.upsert import upsert


def stream_upsert(spark: SparkSession, source_dir: str, schema: StructType | str, table_path: str,
                  keys: Sequence[str], version: Sequence[Column | str], checkpoint: str,
                  partition_col: str | None = None, fmt: str = "json",
                  max_files_per_trigger: int | None = None, timeout_s: float | None = None,
                  processing_time: str | None = None, key_buckets: int | None = None):
    """Drain everything available now into ``table_path`` and stop; with
    ``processing_time`` (e.g. ``"1 minute"``) keep running micro-batches and
    return the ``StreamingQuery`` instead."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.load(source_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        upsert(batch.sparkSession, batch, table_path, keys, version, partition_col, key_buckets)

    writer = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return None
