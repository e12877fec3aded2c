"""Repeated word passages by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words.  Every suffix that starts a whole
window is dealt to a group by a variable-length prefix:

1. Its first prefix is the least-hashed ``ANCHOR``-gram of its first window
   (equal windows have it at the same place).  Consecutive suffixes with one
   anchor travel together as a segment of at most 2 * WINDOW - ANCHOR words,
   so a text is carried about four times, not fifty.
2. Prefixes seen in one document only hold no repeat across documents and go.
   Equal segments under a prefix collapse to one row with the smallest
   document (map-side), so a hot passage is a few rows.
3. Prefixes with up to ``GROUP`` distinct segments are packed into
   memory-sized groups.  Each group's subtrees are built by prefix doubling:
   suffixes get ranks for their first 1, 2, 4 .. 32 and WINDOW words.
   Suffixes with one rank at WINDOW words hang under one deep internal node;
   the node's smallest document decides which of them repeat.
4. Longer groups get a longer prefix, all WINDOW words, and Spark deals their
   suffixes anew: there each group is a single deep node, and its smallest
   document a map-side combined minimum.

Adjacent repeated windows merge to maximal repeated spans.  Documents are
compared by id: a window is removed where a smaller id holds the same words.
Rows with a null id neither remove nor lose anything.  Null, empty and short
texts have no window.  Rows that repeat an id are judged apart and remove
nothing of one another.  The result has a row for every input row; an empty
table gives none.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import kept, picked
from barrio.llm.words import PrefixHash, Words, chunks, grams

WINDOW, ANCHOR = 50, 16
GROUP = 4096                 # distinct segments of a prefix handled in one group
GROUP_WORDS = 1 << 20        # words of a memory-sized group
_AT = np.uint64((1 << 28) - 1)

RUNS = "doc_id long, text_hash long, at int, windows int, key long, seg long"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _segments(words: Words) -> tuple[np.ndarray, ...]:
    """First window, number of windows, prefix and content hash of each segment."""
    n = len(words.hash)
    if n < WINDOW:
        none = np.empty(0, np.int64)
        return none, none, none, none
    g = grams(words.hash, ANCHOR)
    least = _sliding_min((g & ~_AT) | np.arange(len(g), dtype=np.uint64), WINDOW - ANCHOR + 1)
    owner = words.owner
    at = np.flatnonzero(owner[WINDOW - 1:] == owner[:n - WINDOW + 1])
    anchor = (least[at] & _AT).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    start = at[first]
    return (start, windows, g[anchor[first]].view(np.int64),
            PrefixHash(words.hash).of(start, start + windows + WINDOW - 1).view(np.int64))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in chunks(batches, "text"):
        words = Words(data, offsets)
        start, windows, key, seg = _segments(words)
        doc = words.owner[start] if len(start) else start
        take = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("text_hash").take(take),
             pa.array((start - words.bounds[doc]).astype(np.int32)), pa.array(windows.astype(np.int32)),
             pa.array(key), pa.array(seg)],
            names=["doc_id", "text_hash", "at", "windows", "key", "seg"])


def _listed(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of a list<struct> column: each entry's row, and the entries' fields."""
    col = batch.column(name)
    n = np.nan_to_num(col.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = col.flatten()
    return (np.repeat(np.arange(batch.num_rows), n),
            {flat.type.field(i).name: flat.field(i).to_numpy(zero_copy_only=False)
             for i in range(flat.type.num_fields)})


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, .. for length[0] numbers, then the next range."""
    step = np.repeat(start - np.r_[0, np.cumsum(length)[:-1]], length)
    return step + np.arange(len(step))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words (as 64-bit hashes) of the wanted segments of each document."""
    for batch, data, offsets in chunks(batches, "text"):
        words = Words(data, offsets)
        row, want = _listed(batch, "want")
        length = (want["windows"] + WINDOW - 1).astype(np.int64)
        h = words.hash[_ranges(words.bounds[row] + want["at"], length)]
        buffers = [None, pa.py_buffer(np.r_[0, np.cumsum(length * 8)].astype(np.int32)), pa.py_buffer(h)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(want["key"]), pa.array(want["seg"]), pa.array(want["long"]),
             batch.column("doc_id").take(pa.array(row)), pa.array(want["windows"]),
             pa.Array.from_buffers(pa.binary(), len(row), buffers)],
            names=["key", "seg", "long", "doc_id", "windows", "words"])


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    pair = left * np.int64(int(right.max(initial=0)) + 1) + right
    return np.unique(pair, return_inverse=True)[1]


def _deep_nodes(words: np.ndarray, start: np.ndarray, windows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each segment, a bit for each window that a smaller document has too."""
    rank = np.unique(words, return_inverse=True)[1]
    depth = 1
    while depth * 2 <= WINDOW:
        rank = _ranks(rank[:-depth], rank[depth:])
        depth *= 2
    suffix = _ranges(start, windows)
    node = _ranks(rank[suffix], rank[suffix + WINDOW - depth])
    own = np.repeat(doc, windows)
    least = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, own)
    bit = np.int64(1) << _ranges(np.zeros(len(start), np.int64), windows)
    return np.add.reduceat(np.where(least[node] < own, bit, 0), np.cumsum(windows) - windows)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads segments sorted by prefix; builds the subtrees of GROUP_WORDS at a time."""
    def built(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        windows = rows.column("windows").to_numpy().astype(np.int64)
        length = windows + WINDOW - 1
        words = np.concatenate([np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in rows.column("words")])
        mask = _deep_nodes(words, np.cumsum(length) - length, windows, rows.column("doc_id").to_numpy())
        return pa.RecordBatch.from_arrays(
            [rows.column("key").chunk(0), rows.column("seg").chunk(0),
             rows.column("doc_id").chunk(0), pa.array(mask)], names=["key", "seg", "first", "mask"])

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(np.sum(batch.column("windows").to_numpy())) + (WINDOW - 1) * batch.num_rows
        if size >= GROUP_WORDS:
            rows = pa.Table.from_batches(held)
            key = rows.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1], "left"))      # the last prefix may go on
            if cut:
                yield built(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
                size = sum(int(np.sum(b.column("windows").to_numpy())) + (WINDOW - 1) * b.num_rows for b in held)
    if held:
        yield built(pa.Table.from_batches(held))


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of segments, each with the hash of its first WINDOW words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        windows = batch.column("windows").to_numpy().astype(np.int64)
        length = windows + WINDOW - 1
        words = np.concatenate([np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in batch.column("words")])
        suffix = _ranges(np.cumsum(length) - length, windows)
        row = pa.array(np.repeat(np.arange(batch.num_rows), windows))
        bit = _ranges(np.zeros(batch.num_rows, np.int64), windows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(row) for c in ("key", "seg", "doc_id")]
            + [pa.array(bit.astype(np.int32)),
               pa.array(PrefixHash(words).of(suffix, suffix + WINDOW).view(np.int64))],
            names=["key", "seg", "doc_id", "bit", "prefix"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept text and maximal removed spans of each document."""
    for batch, data, offsets in chunks(batches, "text"):
        words = Words(data, offsets)
        n = len(words.hash)
        row, run = _listed(batch, "runs")
        windows = run["windows"].astype(np.int64) if len(row) else np.empty(0, np.int64)
        gone = np.zeros(n, dtype=bool)
        if len(row):
            at = _ranges(words.bounds[row] + run["at"], windows)
            bit = _ranges(np.zeros(len(row), np.int64), windows)
            at = at[(np.repeat(run["mask"], windows) >> bit) & 1 == 1]
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
            gone = np.cumsum(edge[:n]) > 0
        # bytes that stay: those of kept words, and a space after each but a text's last
        stay = np.flatnonzero(~gone)
        owner = words.owner[stay]
        last = np.ones(len(stay), dtype=bool)
        last[:-1] = owner[1:] != owner[:-1]
        until = words.ends[stay] + ~last
        out = data.copy()
        out[words.ends[stay][~last]] = 0x20
        edge = np.zeros(len(data) + 1, dtype=np.int8)
        edge[words.starts[stay]] += 1
        edge[until] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        at = np.r_[0, np.cumsum(inside)][offsets]
        text = pa.Array.from_buffers(pa.large_string(), batch.num_rows,
                                     [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out[inside])])
        # spans in words of their own text
        edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
        starts, ends = edge[::2], edge[1::2]
        cuts = words.bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        cuts = np.unique(cuts[gone[cuts] & gone[cuts - 1]]) if n else cuts
        starts, ends = np.sort(np.r_[starts, cuts]), np.sort(np.r_[ends, cuts])
        doc = words.owner[starts] if len(starts) else starts
        spans = pa.StructArray.from_arrays(
            [pa.array((starts - words.bounds[doc]).astype(np.int32)),
             pa.array((ends - words.bounds[doc]).astype(np.int32))], names=["start", "end"])
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)), spans)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words.counts.astype(np.int64)), spans, text.cast(pa.string())],
            names=["doc_id", "n_words", "spans", "kept_text"])


def _grouped(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, seg, first, mask) of the distinct segments under mixed prefixes."""
    spark = found.sparkSession
    segs = kept(found.groupBy("key", "seg").agg(
        F.min(F.struct("doc_id", "text_hash", "at", "windows")).alias("own")), "rp-segments")
    sizes = kept(segs.groupBy("key").agg(F.count("*").alias("n")).where(f"n > {GROUP}")
                 .select("key", F.lit(True).alias("long")), "rp-long")
    want = (segs.join(sizes, "key", "left").withColumn("long", F.coalesce("long", F.lit(False)))
            .groupBy(F.col("own.doc_id").alias("doc_id"), F.col("own.text_hash").alias("text_hash"))
            .agg(F.collect_list(F.struct(F.col("own.at").alias("at"), F.col("own.windows").alias("windows"),
                                         "key", "seg", "long")).alias("want")))
    # a document on several equal rows gives its segments once
    rows = kept(texts.join(want, ["doc_id", "text_hash"])
                .mapInArrow(_texts, "key long, seg long, long boolean, doc_id long, windows int, words binary")
                , "rp-suffixes")
    size = rows.agg(F.sum(F.col("windows") + WINDOW - 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / GROUP_WORDS))
    small = (rows.where("NOT long").drop("long").repartition(parts, "key").sortWithinPartitions("key", "seg")
             .mapInArrow(_subtrees, "key long, seg long, first long, mask long"))
    long = kept(rows.where("long").mapInArrow(
        _longer, "key long, seg long, doc_id long, bit int, prefix long"), "rp-longer")
    nodes = kept(long.groupBy("key", "prefix").agg(F.min("doc_id").alias("least")), "rp-nodes")
    deep = (long.join(nodes, ["key", "prefix"])
            .groupBy("key", "seg").agg(
                F.min("doc_id").alias("first"),
                F.bit_or(F.when(F.col("least") < F.col("doc_id"), F.expr("shiftleft(1L, bit)"))
                         .otherwise(F.lit(0).cast("long"))).alias("mask")))
    return kept(small.unionByName(deep).groupBy("key", "seg").agg(
        F.min("first").alias("first"), F.max("mask").alias("mask")), "rp-masks")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (word ranges removed) and kept_text of every row."""
    texts = picked(docs, doc_id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))
    with_id = texts.where("doc_id IS NOT NULL AND text IS NOT NULL")
    runs = kept(with_id.mapInArrow(_runs, RUNS), "rp-runs")
    shared = kept(runs.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
                                          (F.min("seg") != F.max("seg")).alias("mixed"))
                  .where("least < most").drop("most"), "rp-shared")
    found = kept(runs.join(shared, "key"), "rp-found")
    whole = F.expr("shiftleft(1L, windows) - 1")
    plain = found.where("NOT mixed AND doc_id > least").withColumn("mask", whole)
    masks = _grouped(found.where("mixed"), with_id)
    mixed = (found.where("mixed").join(masks, ["key", "seg"])
             .withColumn("mask", F.when(F.col("doc_id") > F.col("first"), whole).otherwise(F.col("mask")))
             .where("mask <> 0"))
    cols = ["doc_id", "text_hash", "at", "windows", "mask"]
    gone = (plain.select(cols).unionByName(mixed.select(cols)).groupBy("doc_id", "text_hash")
            .agg(F.collect_set(F.struct("at", "windows", "mask")).alias("runs")))
    return texts.join(gone, ["doc_id", "text_hash"], "left").select("doc_id", "text", "runs").mapInArrow(
        _removed, "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept_text string")
