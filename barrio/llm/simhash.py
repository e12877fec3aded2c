"""Near-duplicate documents by SimHash fingerprints and a byte-position index.

1. Every 3-word shingle of a text, repeats included, votes on the 64 bits of
   its XXH64 hash; a bit is set that over half of the hashes have.
2. Documents with equal fingerprints are one class, its smallest id its name:
   a group of copies, however large, is one row from there on.
3. Two fingerprints within ``BITS`` = 3 differing bits share at least 5 of
   their 8 positional bytes, so at least 3 of the first four or 3 of the last
   four.  The index therefore has a list for each value of the 8 triples of
   byte positions inside one half; every such pair is in a common list.
4. In a list the shared positional bytes of each pair are tallied; pairs that
   reach the 5 are verified by their differing bits.  A list keeps links that
   join it into the components its verified pairs make, no more.
5. A list of over ``LIST`` fingerprints is not compared in full: its pairs must
   share two more of the five other bytes, so it is dealt into lists with one
   byte more (any four of the five), and those again.  After five bytes
   the other three are only 24 bits: what is still crowded there is looked up,
   each fingerprint's neighbours within 3 bits, 2324 of them, among the list.
   So no step makes all pairs of a list, and no pair is passed by.
6. Links contract to components by repeated minima.

A word is a run of bytes outside space and 0x09-0x0D, A-Z lower-cased; the
words of a shingle are joined by one space.  A text with fewer words has its
whole sequence as one shingle; one without words (or null) has the fingerprint
zero, which is linked as any other.  Rows with a null id take no part.  An id
on several rows links their fingerprints; each row is returned.  Texts are
hashed from Arrow buffers, a part of a very long text at a time.  An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.near_dedup import components
from barrio.llm.tables import kept, picked
from barrio.llm.words import SEPARATORS, chunks

SHINGLE, SEED = 3, 42
BITS = 3                     # differing bits of linked fingerprints
SHARED = 8 - BITS            # positional bytes they share at least
LIST = 4096                  # fingerprints of a list that are compared in full
SLICE = 1 << 15              # shingles whose bits are counted at a time
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, bounds): lower-cased words with a space after each.

    ``bounds[d]:bounds[d+1]`` are the words of text ``d``.
    """
    inside = ~_IS_SEP[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = ends - starts
    new_ends = np.cumsum(size + 1) - 1
    out = np.full(int(new_ends[-1]) + 1 if len(size) else 0, 0x20, dtype=np.uint8)
    letters = np.ones(len(out), dtype=bool)
    letters[new_ends] = False
    out[letters] = _LOWER[data[inside]]
    return out, new_ends - size, new_ends, np.searchsorted(starts, offsets)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text."""
    from xxhash import xxh64_intdigest

    spaced, starts, ends, bounds = spaced_words(data, offsets)
    buffer, n = memoryview(spaced), np.diff(bounds)
    counts = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    at = np.r_[0, np.cumsum(counts)]
    votes = np.zeros((len(n), 64), dtype=np.int64)
    # shingle j of a text starts at its word j
    for low in range(0, int(at[-1]), SLICE):
        j = np.arange(low, min(low + SLICE, int(at[-1])))
        owner = np.searchsorted(at, j, "right") - 1
        word = bounds[owner] + j - at[owner]
        to = np.minimum(word + SHINGLE, bounds[owner + 1]) - 1
        hashes = np.fromiter((xxh64_intdigest(buffer[a:b], SEED) for a, b in zip(starts[word].tolist(), ends[to].tolist())),
                             dtype=np.uint64, count=len(j))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
        votes[owner[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    set_ = np.packbits(2 * votes > counts[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(set_).view(np.uint64).ravel()


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in chunks(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(fingerprints(data, offsets).view(np.int64))], names=["doc_id", "fp"])


def _positions(chosen: tuple[int, ...]) -> int:
    """The mask of some byte positions."""
    return sum(0xFF << (8 * p) for p in chosen)


#: Triples of positions inside one half: five shared bytes hold one of them.
TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def differing(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def shared_bytes(x: np.ndarray, y) -> np.ndarray:
    """The tally of positional bytes that fingerprints share."""
    d = x ^ y
    d = d | (d >> np.uint64(4))
    d = d | (d >> np.uint64(2))
    d = (d | (d >> np.uint64(1))) & np.uint64(0x0101010101010101)
    return 8 - np.bitwise_count(d)


class _Forest:
    """Links that join places, and no others."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def list_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links of a list of distinct fingerprints, each compared with those after it."""
    forest = _Forest(len(fps))
    for i in range(len(fps) - 1):
        rest = fps[i + 1:]
        near = np.flatnonzero(shared_bytes(rest, fps[i]) >= SHARED)
        for j in near[differing(rest[near], fps[i]) <= BITS]:
            forest.join(i, i + 1 + int(j))
    return forest.links


def looked_up_links(fps: np.ndarray, free: int) -> list[tuple[int, int]]:
    """The same links, of sorted distinct fingerprints that differ inside the
    mask ``free`` only: neighbours by up to BITS of its bits are looked up."""
    ones = [np.uint64(1 << b) for b in range(64) if free >> b & 1]
    flips = [np.bitwise_xor.reduce(np.array(c, dtype=np.uint64))
             for n in range(1, BITS + 1) for c in combinations(ones, n)]
    forest = _Forest(len(fps))
    for flip in flips:
        near = fps ^ flip
        at = np.minimum(np.searchsorted(fps, near), len(fps) - 1)
        found = np.flatnonzero((fps[at] == near) & (fps < near))
        for i, j in zip(found.tolist(), at[found].tolist()):
            forest.join(i, j)
    return forest.links


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(mask, fingerprints, classes) of each list of rows sorted by (mask, value)."""
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        c = {n: v.to_numpy() for n, v in zip(batch.schema.names, batch.columns)}
        if rest:
            c = {n: np.concatenate([rest[n], c[n]]) for n in c}
        cuts = np.r_[0, np.flatnonzero((np.diff(c["mask"]) != 0) | (np.diff(c["value"]) != 0)) + 1]
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield int(c["mask"][i]), c["fp"][i:j].view(np.uint64), c["rep"][i:j]
        rest = {n: v[cuts[-1]:] for n, v in c.items()}
    if rest:
        yield int(rest["mask"][0]), rest["fp"].view(np.uint64), rest["rep"]


def _links(look_up: bool, limit: int):
    """Links of each list; lists over ``limit`` are looked up or left out."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mask, fps, reps in _lists(batches):
            if len(fps) <= limit:
                links = list_links(fps)
            elif look_up:
                order = np.argsort(fps)
                fps, reps = fps[order], reps[order]
                links = looked_up_links(fps, ~mask & (1 << 64) - 1)
            else:
                continue
            if links:
                ends = np.array(links)
                yield pa.RecordBatch.from_arrays([pa.array(reps[ends[:, 0]]), pa.array(reps[ends[:, 1]])], names=["a", "b"])
    return rows


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")


def _crowded(rows: DataFrame, limit: int) -> DataFrame:
    """The lists of over ``limit`` rows."""
    return rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("mask", "value")


def similar_links(classes: DataFrame, limit: int = LIST) -> DataFrame:
    """(a, b): links between classes (fp, rep) of distinct fingerprints that
    join all those within BITS differing bits."""
    masks = [_signed(_positions(t)) for t in TRIPLES]
    rows = classes.select("fp", "rep", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    rows = rows.withColumn("value", F.expr("fp & mask"))
    out = None
    for n_bytes in range(3, SHARED + 1):
        last = n_bytes == SHARED
        links = _dealt(rows).mapInArrow(_links(last, limit), "a long, b long")
        links = kept(links, f"sh-links-{n_bytes}")
        out = links if out is None else out.unionByName(links)
        if last:
            break
        full = kept(_crowded(rows, limit), f"sh-crowded-{n_bytes}")
        if full.isEmpty():
            break
        # pairs share SHARED - n_bytes of the 8 - n_bytes other bytes: any
        # BITS + 1 of these hold a shared one, so the first ones will do
        masks = {_signed(_positions(t)): t for t in combinations(range(8), n_bytes)}
        more = {m: [_signed(_positions((*t, p))) for p in [p for p in range(8) if p not in t][:BITS + 1]]
                for m, t in masks.items()}
        grown = F.expr("map(" + ", ".join(f"{m}L, array({', '.join(f'{x}L' for x in xs)})"
                                          for m, xs in more.items()).replace("-9223372036854775808L", "long(-9223372036854775808)") + ")")
        rows = kept(rows.join(full, ["mask", "value"], "left_semi")
                    .select("fp", "rep", F.explode(grown[F.col("mask")]).alias("mask"))
                    .distinct().withColumn("value", F.expr("fp & mask")), f"sh-lists-{n_bytes + 1}")
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIST) -> DataFrame:
    """doc_id, fp (the fingerprint as a long), component_id of every row with an id.

    Documents whose fingerprints differ in up to BITS bits are linked;
    component_id is the smallest id reachable through links.
    """
    texts = picked(docs, doc_id=id_col, text=text_col).where("doc_id IS NOT NULL")
    rows = kept(texts.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprint_rows, "doc_id long, fp long"),
                "sh-fingerprints")
    classes = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "sh-classes")
    links = similar_links(classes, limit)
    # an id with several fingerprints links their classes
    several = rows.groupBy("doc_id").agg(F.min("fp").alias("one"), F.max("fp").alias("top")).where("one < top")
    own = rows.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, "fp").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = components(links.unionByName(own), "sh-all").withColumnRenamed("doc_id", "rep")
    named = kept(classes.join(roots, "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id")),
                 "sh-components")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
