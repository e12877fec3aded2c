"""Event time in streams: first events kept, late ones set aside.

Each delivered row is judged once, against the watermark (the newest event
time of earlier micro-batches less the allowed delay):

    late        its event time lies before the watermark
    duplicate   an on-time row of the same key was kept before
    kept        otherwise

Spark's stateful operators drop late rows without a trace.  Here the state
function sees them: the watermark follows the time column, and what reaches
the state carries the event time as a plain value beside an empty event-time
column.  A key is forgotten when the watermark has passed its event time by the
delay, so the state holds the keys of the last two delays, whatever the stream's
length.  A key seen again after that is older than the watermark: late, not kept
twice.

The state function is called once for a bucket of keys (a hash), not once a key:
of keys that come once, each call would judge a single row.  A bucket's state
lists its keys with the last watermark that knows them; its rows come in pieces,
so no bucket need fit in memory but for the keys it keeps in one micro-batch.

The verdicts are written by status, exactly once (the file sink's log and the
stream's checkpoint); kept rows can go on to a keyed upsert.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from barrio.sources.sinks import TEXT_WRITE_OPTIONS

KEPT, LATE, DUPLICATE = "kept", "late", "duplicate"
STATUS, MILLIS, CLOCK, KEY, BUCKET = "_status", "_millis", "_clock", "_key", "_bucket"
BUCKETS = 1024
# Fixed value: the metadata key by which Spark knows an event-time column.  The
# stateful operator drops rows whose event-time column is before the watermark;
# the column it is shown here holds none.
WATERMARK = "spark.watermarkDelayMs"


def _judge(delay_ms: int, columns: list[str]):
    """State function of one bucket of keys: its rows get their verdicts as they come."""
    def judge(bucket: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        mark = state.getCurrentWatermarkMs()
        held = zip(*state.get, strict=True) if state.exists else ()
        ends = {key: end for key, end in held if end >= mark}      # of the keys kept: the last watermark to know them
        newest = mark + delay_ms
        for batch in rows:
            verdicts = []
            for key, ms in zip(batch[KEY], batch[MILLIS], strict=True):
                known = key in ends
                if pd.isna(ms) or ms < mark:
                    verdicts.append(LATE)
                elif known:
                    verdicts.append(DUPLICATE)
                else:
                    verdicts.append(KEPT)
                    ends[key] = int(ms) + delay_ms + 1
                if known:
                    ends[key] = max(ends[key], mark + 1)
                if ms > newest:
                    newest = int(ms)
            yield batch.assign(**{STATUS: verdicts})[[*columns, STATUS]]
        # the next watermark is no less than this bucket's newest time less the delay
        ends = {key: end for key, end in ends.items() if end >= newest - delay_ms}
        if ends:
            state.update((list(ends), list(ends.values())))
            state.setTimeoutTimestamp(max(ends.values()))
        elif state.exists:
            state.remove()
    return judge


def judged(stream: DataFrame, keys: Sequence[str], time: str, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """The stream's rows with ``_status``.  ``delay`` is an interval such as
    ``"10 minutes"``.  Rows without an event time are late.  A checkpoint
    belongs to one number of ``buckets``."""
    columns = stream.columns
    out = StructType([*stream.schema.fields, StructField(STATUS, StringType())])
    ms = _millis(delay)
    plain = [F.expr(f"`{c}` + interval 0 seconds").alias(c) if c == time else F.col(f"`{c}`") for c in columns]
    clock = F.lit(None).cast("timestamp").alias(CLOCK, metadata={WATERMARK: ms})
    key = F.to_json(F.struct(*keys), TEXT_WRITE_OPTIONS)
    rows = stream.withWatermark(time, delay).select(
        *plain, F.unix_millis(F.expr(f"`{time}` + interval 0 seconds")).alias(MILLIS), clock, key.alias(KEY),
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET))
    return rows.groupBy(BUCKET).applyInPandasWithState(
        _judge(ms, columns), out, StructType([StructField("keys", ArrayType(StringType())), StructField("ends", ArrayType(LongType()))]),
        "append", GroupStateTimeout.EventTimeTimeout)


def _millis(delay: str) -> int:
    number, unit = delay.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(float(number) * seconds * 1000)


def judge_files(spark: SparkSession, source_dir: str, schema: StructType | str, out: str, keys: Sequence[str], time: str,
                delay: str, checkpoint: str, fmt: str = "json") -> list[dict]:
    """Drain what has landed into ``out`` (partitioned by ``_status``) and stop.
    Returns the state's size (buckets that hold keys) after each micro-batch."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    q = (judged(stream, keys, time, delay).writeStream.format("parquet").partitionBy(STATUS)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "watermark": p["eventTime"].get("watermark"),
             "keys": sum(s["numRowsTotal"] for s in p["stateOperators"])} for p in q.recentProgress]
