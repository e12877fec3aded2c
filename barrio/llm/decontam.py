"""Benchmark passages in documents by q-gram lemma filtering.

Texts are compared as their letters and digits only: A-Z lowered, every run
of other ASCII bytes one space.  An item of m bytes may occur with up to
k = ``ERRORS`` * m edits.  By the q-gram lemma such an occurrence shares at
least m + 1 - q * (k + 1) q-grams with the item, all on k + 1 neighbouring
diagonals (document place minus item place).

1. The items' q-grams form a sorted table of 64-bit hashes; a bitmap of their
   low bits passes by almost all places of a document.
2. Hits are counted by document, item and diagonal band.  Bands are 2(k + 1)
   diagonals wide and overlap by half, so any k + 1 neighbouring diagonals
   lie inside one.  Bands that meet the bound are retained as regions.  Hits are
   counted a bounded number at a time; a q-gram that an item repeats counts for
   a range of bands at once, so repetitive items cost no product of places.
3. A region is verified by an alignment in a band of diagonals: the fewest
   edits of the item against any part of the region, at most k.

Documents are searched whole, in the task that reads them, and nothing is
shuffled: a row gets the list of its passages.  Items are searched for
``ROUND_BYTES`` at a time: neither the driver nor a task holds more of them.  A
larger benchmark takes several rounds, each written before the next, so the
documents are written once for each further ``ROUND_BYTES`` of items.  An item
is found as a whole: half of a long item is none.

Null, empty and short texts hold nothing.  k is lowered until the bound
is positive, and items under ``LEAST`` bytes get no edits; items shorter than a
q-gram must occur exactly, between words.  Null and empty items are skipped.
Items with equal text are all reported.  Rows are judged each, whatever their
ids.  Empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import col, kept, map_rows, picked, unused
from barrio.llm.words import LOWER, chunks, powers

Q = 9
ERRORS = 0.09
LEAST = 24
REPEATS = 4                 # places of a q-gram in one item that are counted one by one
COUNTED = 1 << 20           # q-gram hits counted at a time
ROUND_BYTES = 1 << 23       # of items searched for at a time
_MAP_BITS = 22
_SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.zeros(256, dtype=bool)
_KEEP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[~_KEEP] = 0x20


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and digits with single spaces between; offsets; original places."""
    n = len(data)
    keep = _KEEP[data]
    stay = keep.copy()
    stay[1:] |= keep[:-1]                      # the first byte of a run of others
    first = offsets[:-1][offsets[:-1] < n]
    stay[first] = keep[first]                  # no space at a text's start
    at = np.flatnonzero(stay)
    return _FOLD[data[at]], np.searchsorted(at, offsets), at


def _gram_hashes(text: np.ndarray, q: int) -> np.ndarray:
    """Rolling hashes of all runs of q bytes."""
    n = len(text) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = LOWER[text]
    out = np.zeros(n, dtype=np.uint64)
    for j, p in enumerate(powers(_BASE, q)):
        out += value[j:j + n] * p
    return out ^ (out >> np.uint64(29))


def _banded(item: np.ndarray, region: np.ndarray, lead: int, k: int) -> tuple[int, int]:
    """Fewest edits of ``item`` against a part of ``region`` that starts within
    the first ``lead`` + 1 places, and where that part ends; k + 1 if over k.

    Row by row over the item, only the diagonals 0 .. lead + k are kept.
    """
    m, width = len(item), lead + 2 * k + 1
    far = k + 1
    # cell d of row i: item[:i] against region ending at place i + d - k
    row = np.where((np.arange(width) >= k) & (np.arange(width) <= k + lead), 0, far)
    padded = np.concatenate([np.full(k, 0x100, np.int16), region.astype(np.int16),
                             np.full(max(0, m + width - len(region) - k), 0x100, np.int16)])
    steps = np.arange(width)
    for i in range(1, m + 1):
        place = padded[i - 1:i - 1 + width]
        best = row + (place != item[i - 1])
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best = np.minimum(best, far)
        # insertions: the least of best[e] + (d - e) over e <= d
        row = np.minimum(np.minimum.accumulate(best - steps) + steps, far)
        if row.min() > k:
            return far, 0
    d = int(row.argmin())
    return int(row[d]), min(max(m + d - k, 0), len(region))


class _Counts:
    """Counts of keys, added up a part at a time."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        key, count = np.unique(keys, return_counts=True)
        self.keys.append(key)
        self.counts.append(count)
        self.held += len(key)
        if self.held > 4 * COUNTED:
            self.keys, self.counts = ([x] for x in self.result())
            self.held = len(self.keys[0])

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        key, which = np.unique(np.concatenate(self.keys), return_inverse=True)
        return key, np.bincount(which, weights=np.concatenate(self.counts)).astype(np.int64)


class Items:
    """Folded benchmark items and the table of their q-grams."""

    def __init__(self, ids: list[int], texts: list[str]):
        col = pa.array(texts, pa.large_string())
        at = np.frombuffer(col.buffers()[1], np.int64)[:len(texts) + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8) if at[-1] else np.empty(0, np.uint8)
        text, at, _ = folded(data, at)
        self.ids, self.texts = [], []
        grams, owner, place = [], [], []
        for i, a, b in zip(ids, at[:-1], at[1:]):
            t = text[a:b]
            t = t[:-1] if len(t) and t[-1] == 0x20 else t
            if len(t):
                q = min(Q, len(t))
                if q == Q:
                    g = _gram_hashes(t, Q)
                    grams.append(g)
                    owner.append(np.full(len(g), len(self.ids)))
                    place.append(np.arange(len(g)))
                self.ids.append(i)
                self.texts.append(t)
        self.m = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.k = np.where(self.m >= LEAST, (self.m * ERRORS).astype(np.int64), 0)
        self.bound = self.m + 1 - Q * (self.k + 1)
        while len(self.m) and ((self.bound < 1) & (self.k > 0)).any():
            self.k = np.where((self.bound < 1) & (self.k > 0), self.k - 1, self.k)
            self.bound = self.m + 1 - Q * (self.k + 1)
        self.short = [j for j in range(len(self.m)) if self.m[j] < Q]
        g = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        owner = np.concatenate(owner) if grams else np.empty(0, np.int64)
        place = np.concatenate(place) if grams else np.empty(0, np.int64)
        order = np.lexsort((place, owner, g))
        g, owner, self.place = g[order], owner[order], place[order]
        # one entry for each q-gram of an item, and the places it has there
        new = np.ones(len(g), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
        self.at = np.flatnonzero(new)
        self.n = np.diff(np.r_[self.at, len(g)])
        self.grams, self.owner = g[self.at], owner[self.at]
        self.map = np.zeros(1 << _MAP_BITS, dtype=bool)
        self.map[(self.grams & np.uint64((1 << _MAP_BITS) - 1)).astype(np.int64)] = True

    def _hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose q-gram may be an item's, and their hashes."""
        places, hashes = [], []
        for a in range(0, max(1, len(text) - Q + 1), _SLICE):
            h = _gram_hashes(text[a:a + _SLICE + Q - 1], Q)
            at = np.flatnonzero(self.map[(h & np.uint64((1 << _MAP_BITS) - 1)).astype(np.int64)])
            places.append(at + a)
            hashes.append(h[at])
        return np.concatenate(places), np.concatenate(hashes)

    def regions(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows (document, item, band) that meet the q-gram bound."""
        at, h = self._hits(text)
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[doc + 1]
        at, h, doc = at[inside], h[inside], doc[inside]
        low = np.searchsorted(self.grams, h, "left")
        n = np.searchsorted(self.grams, h, "right") - low
        at, low, n, doc = at[n > 0], low[n > 0], n[n > 0], doc[n > 0]
        # a band of an item has at most this number
        self.wide = int(((len(text) + self.m) // (self.k + 1)).max(initial=0)) + 2
        counted = _Counts()
        total = np.cumsum(n)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + COUNTED, "right")))
            counted.add(self._bands(at[i:j], doc[i:j], low[i:j], n[i:j], offsets))
            i = j
        key, count = counted.result()
        item = key // self.wide % len(self.m) if len(key) else key
        key = key[count >= np.maximum(self.bound[item], 1)] if len(key) else key
        return np.c_[key // self.wide // len(self.m), key // self.wide % len(self.m), key % self.wide] if len(key) else \
            np.empty((0, 3), np.int64)

    def _bands(self, at: np.ndarray, doc: np.ndarray, low: np.ndarray, n: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A key (document, item, band) for each band that a hit counts for.

        A q-gram counts once for every band that one of its places in the item
        puts it in; of one that the item repeats more than ``REPEATS`` times,
        for the bands from its first place to its last (too many at worst, which
        the alignment settles).
        """
        first = np.cumsum(n) - n
        entry = np.repeat(low - first, n) + np.arange(int(n.sum()))
        at, doc = np.repeat(at, n), np.repeat(doc, n)
        item, size = self.owner[entry], self.n[entry]
        step = self.k[item] + 1
        here = at - offsets[doc] + self.m[item]
        base = (doc * len(self.m) + item) * self.wide
        out = []
        few = np.flatnonzero(size <= REPEATS)
        for r in range(int(size[few].max(initial=0))):
            some = few[size[few] > r]
            band = (here[some] - self.place[self.at[entry[some]] + r]) // step[some]
            # diagonals from -m on; each lies in two bands
            key = np.r_[base[some] + band, (base[some] + band - 1)[band > 0]]
            out.append(key)
        many = np.flatnonzero(size > REPEATS)
        if len(many):
            start = self.at[entry[many]]
            top = (here[many] - self.place[start]) // step[many]
            bottom = np.maximum((here[many] - self.place[start + size[many] - 1]) // step[many] - 1, 0)
            count = top - bottom + 1
            out.append(np.repeat(base[many] + bottom - (np.cumsum(count) - count), count) + np.arange(int(count.sum())))
        return np.concatenate(out)

    def _aligned(self, text: np.ndarray, low: int, high: int, item: int, band: int) -> tuple[int, int, int] | None:
        """(start, end, edits) of an item in the band's region of text[low:high]."""
        m, k = int(self.m[item]), int(self.k[item])
        first = low + band * (k + 1) - m                       # where the band's first diagonal begins
        a, b = max(low, first - k), min(high, first + 2 * (k + 1) + m + k)
        region = text[a:b]
        exact = region.tobytes().find(self.texts[item].tobytes())
        if exact >= 0:
            return a + exact, a + exact + m, 0
        if not k:
            return None
        edits, end = _banded(self.texts[item], region, max(0, first + 2 * k + 1 - a), k)
        return (max(a, a + end - m - k), a + end, edits) if edits <= k else None

    def _exact(self, text: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """Occurrences of the items shorter than a q-gram, between words."""
        whole = text.tobytes()
        for item in self.short:
            wanted = self.texts[item].tobytes()
            at = whole.find(wanted)
            while at >= 0:
                doc = int(np.searchsorted(offsets, at, "right") - 1)
                end = at + len(wanted)
                if (at == offsets[doc] or whole[at - 1] == 0x20) and end <= offsets[doc + 1] and (
                        end == offsets[doc + 1] or whole[end] == 0x20):
                    yield doc, item, at, end, 0
                at = whole.find(wanted, at + 1)

    def verified(self, text: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, start, end, edits) of the occurrences, folded places.

        Of an item's overlapping occurrences the one with fewest edits is given.
        """
        found = list(self._exact(text, offsets))
        for doc, item, band in self.regions(text, offsets).tolist():
            hit = self._aligned(text, int(offsets[doc]), int(offsets[doc + 1]), item, band)
            if hit:
                found.append((doc, item, *hit))
        out: list[tuple[int, int, int, int, int]] = []
        by_item: dict[tuple[int, int], tuple[list, list]] = {}
        for row in sorted(found, key=lambda r: (r[4], r[2], r[3])):
            # those taken lie apart, so only the one before and the one after can overlap
            starts, ends = by_item.setdefault(row[:2], ([], []))
            at = bisect_left(starts, row[3])
            if at == 0 or ends[at - 1] <= row[2]:
                starts.insert(at, row[2])
                ends.insert(at, row[3])
                out.append(row)
        return sorted(out)


def _search(ids: list[int], texts: list[str], text_col: str, name: str):
    """Adds the passages of some items to each row's list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(ids, texts)
        for batch, data, offsets in chunks(batches, text_col):
            text, at, places = folded(data, offsets)
            rows = items.verified(text, at)
            lists = batch.column(name).to_pylist()
            for d, item, start, end, edits in rows:
                lists[d] = lists[d] + [{
                    "item_id": items.ids[item], "start": int(places[start] - offsets[d]),
                    "end": int(places[end - 1] + 1 - offsets[d]), "edits": int(edits)}]
            where = batch.schema.get_field_index(name)
            field = batch.schema.field(where)
            yield batch.set_column(where, field, pa.array(lists, field.type)) if rows else batch
    return run


def _rounds(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """The items, ROUND_BYTES at a time (or one item)."""
    ids, texts, size = [], [], 0
    for row in benchmark.where("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        n = len(row["text"].encode())
        if ids and size + n > ROUND_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += n
    if ids:
        yield ids, texts


def benchmark_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       name: str = "passages") -> DataFrame:
    """All columns of ``docs`` and a list of the passages of each row:
    item_id, start and end (UTF-8 bytes in the text) and edits.

    The list's column is ``name``, with ``_`` added while the input has it.
    """
    name = unused(docs, name)
    out = docs.withColumn(name, F.expr("cast(array() as array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>)"))
    done = 0
    for ids, texts in _rounds(picked(benchmark, item_id="item_id", text="text")):
        # one round's items alive at a time, in the driver as in the tasks
        out = map_rows(kept(out, "bd-round") if done else out, _search(ids, texts, text_col, name))
        done += 1
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage."""
    found = benchmark_passages(docs, benchmark, text_col)
    return found.where(F.size(col(found.columns[-1])) == 0).select(*map(col, docs.columns))
