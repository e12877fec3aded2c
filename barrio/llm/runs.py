"""Runs of equal keys in range-sorted rows, in bounded pieces.

Rows are dealt by ranges of (key, order), so a key of any size is spread over
many tasks and every task reads its rows in order.  A key that lies whole
inside one task is handled there.  Of any other (the first and the last of a
task, and keys above the limits) the pieces are numbered by (part, at), which
rises along the key's order over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_ROWS = 1024            # rows of a piece
PIECE_BYTES = 1 << 16        # bytes of a piece (or one row)
REMEMBERED = 1 << 14         # results of a function kept in a worker
_READ = 1024                 # rows taken from a batch at a time


def remembered(fn):
    """``fn`` with its latest results kept (workers get it by value)."""
    results: dict = {}

    def call(*args):
        if args not in results:
            if len(results) >= REMEMBERED:
                results.clear()
            results[args] = fn(*args)
        return results[args]
    return call


def in_order(rows: DataFrame, place: list, order: list) -> DataFrame:
    """``rows`` sorted by ``order`` over range partitions of ``place`` (bounded
    values, a coarsening of the order), with their partition's number ``part``."""
    return (rows.repartitionByRange(*place).sortWithinPartitions(*order)
            .withColumn("part", F.spark_partition_id()))


def pieces(batches: Iterator[pa.RecordBatch], key: Callable[[dict], object], size: Callable[[dict], int],
           max_rows: int = PIECE_ROWS, max_bytes: int = PIECE_BYTES
           ) -> Iterator[tuple[bool, int, list[dict]]]:
    """(whole, at, rows) of each key's run in one task's sorted rows."""
    run: list[dict] = []
    held = at = 0
    first, started = True, False             # of the task's first key; of a run given in part
    for batch in batches:
        for i in range(0, batch.num_rows, _READ):
            for row in batch.slice(i, _READ).to_pylist():
                if run and key(run[0]) != key(row):
                    yield not first and not started, at, run
                    run, held, at, first, started = [], 0, 0, False, False
                elif run and (len(run) >= max_rows or held + size(row) > max_bytes):
                    yield False, at, run
                    run, held, at, started = [], 0, at + 1, True
                run.append(row)
                held += size(row)
    if run:
        yield False, at, run


def _digested(keys: list[str], separator: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = None
        for whole, at, rows in pieces(batches, lambda r: [r[k] for k in keys], lambda r: len(r["piece"] or "")):
            text = separator.join(r["piece"] for r in rows)
            out = {k: rows[0][k] for k in keys} | {"part": rows[0]["part"], "at": at}
            out |= {"sha256": hashlib.sha256(text.encode()).hexdigest() if whole else None,
                    "text": None if whole else text}
            fields = fields or pa.schema([pa.field(k, pa.int64()) for k in keys] + [
                ("part", pa.int32()), ("at", pa.int32()), ("sha256", pa.string()), ("text", pa.string())])
            yield pa.RecordBatch.from_pylist([out], fields)
    return digest


def _chained(keys: list[str], separator: str):
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([pa.field(k, pa.int64()) for k in keys] + [("sha256", pa.string())])
        now, state = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                key = {k: row[k] for k in keys}
                if key != now:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([now | {"sha256": state.hexdigest()}], fields)
                    now, state = key, hashlib.sha256(row["text"].encode())
                else:
                    state.update((separator + row["text"]).encode())
        if state is not None:
            yield pa.RecordBatch.from_pylist([now | {"sha256": state.hexdigest()}], fields)
    return chain


def chained_digests(parts: DataFrame, keys: list[str], separator: str) -> DataFrame:
    """(keys, sha256) of the pieces (keys, part, at, text) joined in order.

    A digest runs over its pieces one after another: a task holds one piece.
    Keys are long and may be null.
    """
    schema = ", ".join(f"{k} long" for k in keys) + ", sha256 string"
    rows = parts.select(*keys, "part", "at", "text").repartition(*keys).sortWithinPartitions(*keys, "part", "at")
    return rows.mapInArrow(_chained(keys, separator), schema)


def ordered_digests(rows: DataFrame, keys: list[str], order: Column, piece: Column, separator: str,
                    keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(keys, sha256) of each key's ``piece`` strings joined in ``order``.

    ``keep`` writes a table and reads it again.  Keys are long.
    """
    rows = rows.select(*keys, order.alias("order"), piece.alias("piece"))
    schema = ", ".join(f"{k} long" for k in keys)
    parts = keep(in_order(rows, [*keys, "order"], [*keys, "order"]).mapInArrow(
        _digested(keys, separator), f"{schema}, part int, at int, sha256 string, text string"))
    return (parts.where("sha256 IS NOT NULL").select(*keys, "sha256")
            .unionByName(chained_digests(parts.where("text IS NOT NULL"), keys, separator)))
