"""Row numbers over a whole table without a window in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: ``monotonically_increasing_id`` holds the partition above these bits.
ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[str | Column], out: str = "n", total: str = "total") -> DataFrame:
    """Rows with their number (from 1) in the order of the whole table, and the
    table's rows: a range sort, and to each of its partitions the rows of those
    before it.  Only one count per partition reaches the driver.  The sorted
    rows are checkpointed: their numbers stay as counted."""
    rows = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright("_at", ROW_BITS)
    before, offsets = 0, []
    for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        offsets.append((r.part, before))
        before += r.n
    first = df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return rows.join(F.broadcast(first), part == F.col("_part")).select(
        *df.columns, place.alias(out), F.lit(before).cast("bigint").alias(total))
