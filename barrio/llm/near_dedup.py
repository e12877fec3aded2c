"""Near-duplicate documents by b-bit MinHash.

1. A Python pass hashes each text's 5-word shingles and takes ``HASHES``
   minima.  Bands of ``ROWS`` full minima give candidate keys; of every
   minimum only ``BITS`` low bits are retained, packed into 64-bit integers.
2. Texts with equal shingle sets collapse to one representative (a map-side
   combined ``min``), so a huge group of copies is one row from there on.
3. Candidates are compared by bit counts of the packed signatures: of two
   texts with similarity J a slot agrees with probability C + (1 - C) J,
   C = 2^-BITS, so J is estimated as (agreeing / slots - C) / (1 - C).  Pairs
   within ``SIGMAS`` standard errors of the threshold, or over it, are
   confirmed on their full shingle sets.
4. First every band bucket's members are compared with its smallest id.  The
   links contract to components (repeated ``min`` over edges).  Then only
   buckets that still hold several components are compared: the rows outside
   the bucket's largest component (strays) with all others of the bucket,
   across components only, in tiles of bounded size; a tile confirms its most
   alike candidates first and passes by those that its links have joined
   meanwhile.
   Pairs inside a component change nothing, so no link between components is
   lost, and no step makes a row for each pair of a bucket.

Rows with a null id take no part and are not returned.  A null or empty text
and one without words have an empty set and are linked with nothing.  An id on
several rows is one document: links of any of its texts count, and n_shingles
is the largest.  An empty table gives an empty result.  Other columns are never touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import kept, picked
from barrio.llm.words import Words, chunks, grams, join2, mix

SHINGLE = 5
BANDS, ROWS, BITS = 32, 5, 4
HASHES = BANDS * ROWS
SIGMAS = 4.5
BLOCK = 1024                 # rows of a bucket compared with as many at a time

SIGNATURES = ("doc_id long, n_shingles long, set_a long, set_b long, "
              "bands array<long>, bits array<long>")


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes text by text, sorted, and each text's first one.

    A text with fewer than ``SHINGLE`` words has its whole sequence as one.
    """
    words = Words(data, offsets, lower=True)
    counts = words.counts
    hashes, owners = [], []
    whole = grams(words.hash, SHINGLE)
    if len(whole):
        owner = words.owner[:len(whole)]
        ok = words.owner[SHINGLE - 1:] == owner
        hashes.append(whole[ok])
        owners.append(owner[ok])
    for n in range(1, SHINGLE):
        docs = np.flatnonzero(counts == n)
        if len(docs):
            at = words.bounds[docs]
            value = words.hash[at]
            for j in range(1, n):
                value = join2(value, words.hash[at + j])
            hashes.append(mix(value + np.uint64(n)))
            owners.append(docs)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(counts) + 1))


def _minima(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of HASHES 32-bit minima for each non-empty range of ``h``."""
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(first)), dtype=np.uint32)
    for j in range(HASHES):
        a = np.uint32(int(seeds[2 * j]) & 0xFFFFFFFF | 1)
        b = np.uint32(int(seeds[2 * j + 1]) >> 32)
        y = x * a + b
        y ^= y >> np.uint32(15)
        out[j] = np.minimum.reduceat(y, first)
    return out.T


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low BITS bits of each (scrambled) minimum, 64 // BITS to an integer."""
    low = mix(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    low = low.reshape(len(low), HASHES // per, per)
    return np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def _longs(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).view(np.int64).ravel())
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), flat)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in chunks(batches, "text"):
        h, at = shingle_sets(data, offsets)
        n = np.diff(at)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        minima = _minima(h, at[some])
        rows = minima.reshape(len(some), BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(some), BANDS))
        for r in range(ROWS):
            key = join2(key, rows[:, :, r])
        sums = [np.add.reduceat(mix(h ^ np.uint64(salt)), at[some]) for salt in (0, 0x5BD1E995)]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(pa.array(some)), pa.array(n[some]),
            pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
            _longs(key), _longs(_packed(minima))],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in chunks(batches, "text"):
        h, at = shingle_sets(data, offsets)
        # as binary values: one buffer of 8 bytes per shingle
        buffers = [None, pa.py_buffer((at * 8).astype(np.int64)), pa.py_buffer(h)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"),
             pa.Array.from_buffers(pa.large_binary(), batch.num_rows, buffers).cast(pa.binary())],
            names=["doc_id", "shingles"])


def _slots_needed(percent: int) -> int:
    """Fewest agreeing slots of a pair that is worth confirming."""
    c = 2.0 ** -BITS
    p = c + (1 - c) * percent / 100
    return int(np.floor(HASHES * p - SIGMAS * np.sqrt(HASHES * p * (1 - p))))


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Slots that agree between each row of ``a`` and the row ``b``."""
    x = a ^ b
    step = 1
    while step < BITS:
        x = x | (x >> np.uint64(step))
        step *= 2
    ones = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    return HASHES - np.bitwise_count(x & ones).sum(axis=-1, dtype=np.int64)


def _agreeing_sql(a: str, b: str) -> str:
    """The same count as a Spark expression over the packed arrays."""
    ones = sum(1 << i for i in range(0, 64, BITS))
    ones -= (1 << 64) if ones >= 1 << 63 else 0
    fold, step = "x", 1
    while step < BITS:
        fold = f"({fold} | shiftrightunsigned({fold}, {step}))"
        step *= 2
    return (f"{HASHES} - aggregate(zip_with({a}, {b}, (p, q) -> p ^ q), 0, "
            f"(n, x) -> n + bit_count({fold} & {ones}L))")


def _similar(left, right, percent: int) -> bool:
    both = np.concatenate([np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def _confirmed(percent: int):
    """Keeps the pairs whose sets are similar enough."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_similar(a.as_buffer(), b.as_buffer(), percent)
                  for a, b in zip(batch.column("set_left"), batch.column("set_right"))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return keep


def _sets_of(texts: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """(doc_id, shingles) of some documents, written."""
    # one plan at every size: the ids grow with the documents
    return kept(texts.join(ids.distinct().hint("merge"), "doc_id", "left_semi").mapInArrow(
        _sets, "doc_id long, shingles binary"), name)


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough, written."""
    pairs = kept(pairs, "nd-pairs")
    sets = _sets_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), "nd-pair-sets")
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_left")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_right")), "b"))
    return kept(both.mapInArrow(_confirmed(percent), "a long, b long"), "nd-links")


def _checksum(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(doc_id, root): the smallest id reachable from each end of the edges.

    Rounds of large-star and small-star: every round hangs each vertex's
    larger, then smaller, neighbours on the smallest of them, by joins and
    map-side combined minima, until nothing moves.  Written each round; the
    driver sees a count and a checksum.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), f"{name}-star")
    before = _checksum(edges)
    while True:
        near = kept(both(edges).groupBy("a").agg(F.min("b").alias("m"))
                    .select("a", F.least("a", "m").alias("m")), f"{name}-min")
        large = kept(both(edges).where("b > a").join(near, "a")
                     .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-large")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
        edges = kept(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(least.select("a", F.col("m").alias("b")))
                     .where("a <> b").distinct(), f"{name}-star")
        after = _checksum(edges)
        if after == before:
            return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("root"))
        before = after


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The whole tiles, one by one, of rows sorted by tile."""
    rest = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        c = {}
        for name, values in zip(batch.schema.names, batch.columns):
            if pa.types.is_list(values.type):
                c[name] = values.flatten().to_numpy().view(np.uint64).reshape(n, -1)
            elif pa.types.is_binary(values.type):
                c[name] = np.array([v.as_buffer() for v in values] + [None], dtype=object)[:-1]
            else:
                c[name] = values.to_numpy(zero_copy_only=False)
        if rest:
            c = {name: np.concatenate([rest[name], c[name]]) for name in c}
        new = (np.diff(c["key"]) != 0) | (np.diff(c["x"]) != 0) | (np.diff(c["y"]) != 0)
        cuts = np.r_[0, np.flatnonzero(new) + 1]
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield {name: v[i:j] for name, v in c.items()}
        rest = {name: v[cuts[-1]:] for name, v in c.items()}
    if rest:
        yield rest


def _candidates(t: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, ...]:
    """Rows i (strays) and j (members) of a tile in different components that look
    similar, and their agreeing slots.  A pair is given in the first band both
    share, so once.  A stray is a row outside the bucket's home component.
    """
    need, out = _slots_needed(percent), []
    key = t["key"][:1].view(np.uint64)[0]
    strays, members = np.flatnonzero(t["side"]), np.flatnonzero(t["side"] == 0)
    roots, ids, sizes = t["root"][members], t["doc_id"][members], t["n_shingles"][members]
    bits, bands = t["bits"][members], t["bands"][members]
    member_strays = roots != t["home"][members]
    for r in strays:
        size = t["n_shingles"][r]
        # two strays meet twice: each is a member too
        ok = (roots != t["root"][r]) & ~(member_strays & (ids < t["doc_id"][r]))
        ok &= 100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)
        ok = np.flatnonzero(ok)
        if len(ok):
            agree = _agreeing(bits[ok], t["bits"][r])
            ok, agree = ok[agree >= need], agree[agree >= need]
        if len(ok):
            first = t["bands"][r][(bands[ok] == t["bands"][r]).argmax(axis=1)] == key
            out.append((np.full(first.sum(), r), members[ok[first]], agree[first]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


OPEN = ["key", "x", "y", "side", "home", "doc_id", "root"]


def _open_rows(percent: int):
    """The rows of each tile that have a candidate."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _tiles(batches):
            i, j, _ = _candidates(t, percent)
            if len(i):
                at = np.unique(np.r_[i, j])
                yield pa.RecordBatch.from_arrays([pa.array(t[n][at]) for n in OPEN], names=OPEN)
    return rows


def _confirmed_links(percent: int):
    """Links that join components of a tile, most alike candidates first.

    A pair whose components are one already is passed by; every other
    candidate is confirmed on the full sets.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _tiles(batches):
            i, j, agree = _candidates(t, percent)
            up: dict[int, int] = {}

            def top(x: int) -> int:
                while (y := up.get(x, x)) != x:
                    up[x] = x = up.get(y, y)
                return x

            links = []
            for r in np.argsort(-agree, kind="stable"):
                a, b = i[r], j[r]
                left, right = top(int(t["root"][a])), top(int(t["root"][b]))
                if left != right and _similar(t["shingles"][a], t["shingles"][b], percent):
                    up[left] = right
                    links.append((t["doc_id"][a], t["doc_id"][b]))
            if links:
                ends = np.array(links)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])
    return rows


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows of (key, n, strays, ...) with tiles (x, y): a bucket's members are cut
    into blocks x of about BLOCK rows by a hash of the id, its strays into blocks
    y, and each pair of blocks is a tile.  Members of the home component meet the
    strays only, so a bucket of n rows and s strays makes n * s / BLOCK copies."""
    def block(count: str, salt: int) -> str:
        return f"cast(pmod(xxhash64(doc_id, {salt}), ceil({count} / {BLOCK})) as int)"

    def every(count: str):
        return F.explode(F.expr(f"sequence(0, cast(ceil({count} / {BLOCK}) as int) - 1)"))

    members = rows.withColumn("side", F.lit(0)).withColumn("x", F.expr(block("n", 7))).withColumn("y", every("strays"))
    strays = (rows.where("root <> home").withColumn("side", F.lit(1)).withColumn("y", F.expr(block("strays", 8)))
              .withColumn("x", every("n")))
    return members.unionByName(strays)


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document with an id.

    Documents are linked when 100 * shared >= percent * united distinct
    shingles; component_id is the smallest id reachable through links.
    """
    texts = picked(docs, doc_id=id_col, text=text_col).where("doc_id IS NOT NULL")
    sigs = kept(texts.mapInArrow(_signatures, SIGNATURES), "nd-signatures")
    # equal sets: one representative
    same = kept(sigs.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "nd-sets")
    own = same.withColumnRenamed("rep", "doc_id")
    reps = kept(sigs.join(own, own.columns, "left_semi").dropDuplicates(own.columns), "nd-reps")

    slots = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = kept(slots.groupBy("key").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n"))
                   .where("n > 1").select("key", "leader"), "nd-buckets")
    members = kept(slots.join(buckets, "key"), "nd-members")
    small = reps.select("doc_id", "n_shingles", "bits")
    lead = lambda side: small.select(*[F.col(c).alias(f"{c}_{side}") for c in small.columns])
    star = (members.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
            .distinct()
            .join(lead("a"), F.col("a") == F.col("doc_id_a"))
            .join(lead("b"), F.col("b") == F.col("doc_id_b"))
            .where(f"100 * least(n_shingles_a, n_shingles_b) >= {percent} * greatest(n_shingles_a, n_shingles_b)")
            .where(F.expr(f"{_agreeing_sql('bits_a', 'bits_b')} >= {_slots_needed(percent)}"))
            .select("a", "b"))
    links = _links(star, texts, percent)

    roots = components(links, "nd-first")
    rooted = kept(members.join(roots, "doc_id", "left")
                  .select("key", "doc_id", F.coalesce("root", "doc_id").alias("root")), "nd-rooted")
    # home is the component with most rows of the bucket
    held = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = kept(held.groupBy("key").agg(
        F.max(F.struct("n", (-F.col("root")).alias("r"))).alias("most"), F.sum("n").alias("n"), F.count("*").alias("roots"))
        .where("roots > 1").select("key", (-F.col("most.r")).alias("home"), "n", (F.col("n") - F.col("most.n")).alias("strays")),
        "nd-mixed")
    open_ = (rooted.join(mixed, "key")
             .join(reps.select("doc_id", "n_shingles", "bits", "bands"), "doc_id"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_tile(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "key", "x", "y").sortWithinPartitions("key", "x", "y", "doc_id")

    near = kept(by_tile(_tiled(open_).select(*OPEN, "n_shingles", "bits", "bands")).mapInArrow(
        _open_rows(percent), "key long, x int, y int, side int, home long, doc_id long, root long"), "nd-open")
    sets = _sets_of(texts, near.select("doc_id"), "nd-open-sets")
    rest = kept(by_tile(near.join(reps.select("doc_id", "n_shingles", "bits", "bands"), "doc_id")
                        .join(sets, "doc_id"))
                .mapInArrow(_confirmed_links(percent), "a long, b long"), "nd-rest")

    copies = sigs.join(same.select("set_a", "set_b", "n_shingles", "rep"), ["set_a", "set_b", "n_shingles"])
    copies = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    final = components(links.unionByName(rest).unionByName(copies), "nd-all")
    sizes = sigs.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    return (texts.select("doc_id").distinct().join(sizes, "doc_id", "left").join(final, "doc_id", "left")
            .select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"),
                    F.coalesce("root", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
