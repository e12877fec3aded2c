"""Quality by importance resampling with hashed n-gram models.

Target text: documents labelled good (quality 1, not toxic).  Raw text: all
documents.  Both are generative models over hashed n-grams: a document draws
each n-gram at most once, and counts are of documents.  The n-grams are words
(A-Z lowered, without punctuation), the first ``HEAD`` bytes of words, word
shapes (runs of upper case, other letters, digits and each punctuation mark;
a word that repeats its predecessor has a shape of its own), and pairs of
neighbouring shapes, hashed to buckets whose number grows with the bytes of all
texts (``bits_for``).

An n-gram's weight is its log ratio ``log((t + PRIOR) / (e + PRIOR))``, drawn
towards 0 by ``SHRINK`` standard errors; t documents of target text have it, and
e would if target text were like raw text.  So rare n-grams, of which most of a
language's words are, add no noise that grows with a text's length.  The mean
weight of a target n-gram is taken off each: documents are compared at equal
length.  Raw counts cover all documents, as sums that combine in each task;
target counts use at most ``LABELLED`` labelled documents (those with the
smallest hashes of their ids), and a document in the target is scored without
its own counts.

A sum's mean and spread still change with the number of n-grams: a long text
holds more rare n-grams, with small weights below 0.  Both are fitted to the
good documents over that number (``_length_fit``), and the score is the sum
less the mean, divided by the spread where that is over that of a short text.
So one cut loses no more of the long good documents than of the short ones.
Beyond the longest good document the mean goes on in proportion.

The score is the log importance weight.  Resampling without replacement: a
Gumbel variable hashed from the id is added and the top k are kept.  k is
either given (the k-th score is found on counts of score ranges, not by a sort
in one task) or, with labels, the number of documents at or over the perturbed
score that best parts good from other labelled documents while ``KEEP_GOOD``
of the good ones stay.

Only buckets with a weight pass the driver, and counts of
labelled documents by length and by score, at most ``LABELLED``.  Null and empty
texts have no n-grams and score 0.  A null id gets the Gumbel variable of an
empty id; rows that repeat an id share it, and rows with equal perturbed
scores at the cut are all kept.  Labels of null or unknown ids do nothing; a
label that is null is not good.  Without a good label all scores are 0 and,
with no k, every document is kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import col, kept, map_rows, unused
from barrio.llm.words import LOWER, Words, chunks, join2, mix, powers, range_hashes

LEAST_BITS, MOST_BITS, HEAD = 20, 28, 4
DENSE_BITS = 22                 # up to here an array has a place for every bucket
PRIOR, SHRINK = 1.0, 1.5
LABELLED = 200_000
KEEP_GOOD = 0.99
DRIFT, ROUNDS = (0.0, 1.0, 1.5), 3               # powers of the length in a score's mean

_UPPER, _LETTER, _DIGIT = 1, 2, 3
_CLASS = np.arange(256, dtype=np.uint64)         # a punctuation mark is its own class
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _UPPER
_CLASS[0x61:0x7B] = _LETTER
_CLASS[0x80:] = _LETTER
_CLASS_HASH = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))
_RANK = powers(np.uint64(0x9E3779B97F4A7C15), 16)


def bits_for(size: int) -> int:
    """Bits of a bucket for so many bytes of text: 20 for up to a GB, and one more
    for each fourfold, as distinct n-grams grow about with the root of the text."""
    return min(MOST_BITS, LEAST_BITS + max(0, math.ceil(math.log(max(size, 1) / (1 << 30), 4))))


def _sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's runs of byte classes (the first 16 in order)."""
    length = ends - starts
    first = np.cumsum(length) - length
    cls = _CLASS[data[np.repeat(starts - first, length) + np.arange(int(length.sum()))]]
    new = np.ones(len(cls), dtype=bool)
    new[1:] = cls[1:] != cls[:-1]
    new[first] = True
    run = np.flatnonzero(new)
    at = np.searchsorted(run, first)
    rank = np.minimum(np.arange(len(run)) - np.repeat(at, np.diff(np.append(at, len(run)))), 15)
    return np.add.reduceat(_CLASS_HASH[cls[run]] * _RANK[rank], at)


def ngrams(data: np.ndarray, offsets: np.ndarray, bits: int = LEAST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each document's distinct n-grams, and the documents."""
    words, low = Words(data, offsets), np.uint64((1 << bits) - 1)
    if not len(words.hash):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # n-grams of each distinct word
    _, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
    order = np.argsort(at)
    starts, ends = words.starts[at[order]], words.ends[at[order]]
    back = np.empty(len(at), dtype=np.int64)
    back[order] = np.arange(len(at))
    which = back[which]
    shape = _shapes(data, starts, ends)
    body = np.flatnonzero((_CLASS[data] <= _DIGIT) & (_CLASS[data] > 0))
    a, b = np.searchsorted(body, starts), np.searchsorted(body, ends)
    some = np.flatnonzero(b > a)
    s, e = body[a[some]], body[b[some] - 1] + 1
    word, head = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    word[some] = range_hashes(data, s, e, LOWER)
    head[some] = range_hashes(data, s, np.minimum(e, s + HEAD), LOWER)
    kinds = [(mix(x + np.uint64(k)) & low).astype(np.int64) for k, x in enumerate((word, head, shape))]
    owner = words.owner
    pair = _sorted_distinct(owner * len(at) + which)
    doc, which_one = pair // len(at), pair % len(at)
    keys = [(doc << bits) | kind[which_one] for kind in kinds]
    # pairs of neighbouring shapes
    names, small = np.unique(shape, return_inverse=True)
    small = small[which]
    small[1:][(words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])] = len(names)
    names = mix(np.append(names, np.uint64(99)))
    ok = owner[1:] == owner[:-1]
    wide = len(names)
    both = _sorted_distinct((owner[1:][ok] * wide + small[:-1][ok]) * wide + small[1:][ok])
    pairs = join2(names[both // wide % wide], names[both % wide])
    keys.append(((both // (wide * wide)) << bits) | (mix(pairs + np.uint64(3)) & low).astype(np.int64))
    key = _sorted_distinct(np.concatenate(keys))
    return key & ((1 << bits) - 1), key >> bits


def _good(label: pa.Array) -> np.ndarray:
    return label.fill_null(0).to_numpy() == 1


def _counts(bits: int):
    """Raw and target documents with each n-gram, of one task."""
    def rows(buckets: np.ndarray, raw: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.array(raw), pa.array(target)],
                                          names=["bucket", "raw", "target"])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch, data, offsets in chunks(batches, "text"):
            bucket, owner = ngrams(data, offsets, bits)
            raw += np.bincount(bucket, minlength=1 << bits)
            good = _good(batch.column("label"))
            target += np.bincount(bucket[good[owner]], minlength=1 << bits)
        some = np.flatnonzero(raw)
        yield rows(some, raw[some], target[some])

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sums of each part of the texts; Spark adds them up before it shuffles
        for batch, data, offsets in chunks(batches, "text"):
            bucket, owner = ngrams(data, offsets, bits)
            good = _good(batch.column("label"))
            some, which = np.unique(bucket, return_inverse=True)
            yield rows(some, np.bincount(which, minlength=len(some)).astype(np.int64),
                       np.bincount(which, weights=good[owner], minlength=len(some)).astype(np.int64))
    return dense if bits <= DENSE_BITS else sparse


def _weight(target, expected):
    """Log ratio, SHRINK standard errors nearer to 0 (numbers or columns)."""
    ratio = np.log((target + PRIOR) / (expected + PRIOR))
    error = SHRINK * np.sqrt(1 / (target + PRIOR) + 1 / (expected + PRIOR))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - error, 0)


def _lookup(bits: int, bucket: np.ndarray, values: np.ndarray):
    """Values by bucket, 0 where there is none."""
    if bits <= DENSE_BITS:
        table = np.zeros(1 << bits)
        table[bucket] = values
        return lambda wanted: table[wanted]
    order = np.argsort(bucket)
    known, values = np.append(bucket[order], -1), np.append(values[order], 0.0)

    def found(wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known[:-1], wanted)
        return np.where(known[at] == wanted, values[at], 0.0)
    return found


def _scores(names: dict[str, str], bits: int, bucket: np.ndarray, raw: np.ndarray, target: np.ndarray, share: float,
            level: float):
    """Rows with the number and the summed weights of their n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = _lookup(bits, bucket, _weight(target, raw * share))
        less = _lookup(bits, bucket, _weight(np.maximum(target - 1, 0), np.maximum(raw - 1, 0) * share))
        for batch, data, offsets in chunks(batches, names["text"]):
            grams, owner = ngrams(data, offsets, bits)
            good = _good(batch.column(names["label"]))[owner]
            value = np.empty(len(grams))
            value[good], value[~good] = less(grams[good]), weight(grams[~good])
            score = np.bincount(owner, weights=value - level, minlength=batch.num_rows).astype(np.float64)
            count = np.bincount(owner, minlength=batch.num_rows).astype(np.int64)
            for name, values in ((names["score"], score), (names["grams"], count)):
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values))
            yield batch
    return run


def _gumbel(doc_id: Column, seed: int) -> Column:
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"|gumbel|{seed}"))
    u = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5
    return -F.log(-F.log(u / float(1 << 52)))


def _length_fit(judged: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean and variance of a good document's sum, over thousands of n-grams x.

    Coefficients of x ** DRIFT, and of x and x ** 2, by weighted least squares;
    each is drawn to 0 as by one document.  And the largest x fitted.
    """
    good = (judged.where("label = 1 AND grams > 0").groupBy("grams")
            .agg(F.count("*").alias("n"), F.sum("score").alias("s"), F.sum(F.col("score") * F.col("score")).alias("q"))
            .orderBy("grams").toPandas())
    mean, spread = np.zeros(len(DRIFT)), np.zeros(2)
    if not len(good):
        return mean, spread, 1.0
    x, n, s, q = (good[c].to_numpy(np.float64) for c in ("grams", "n", "s", "q"))
    x = x / 1000
    drift, square = np.stack([x ** p for p in DRIFT], 1), np.stack([x, x * x], 1)
    variance = x
    for _ in range(ROUNDS):
        w = 1 / (0.1 + variance)
        mean = np.linalg.solve((drift * (w * n)[:, None]).T @ drift + np.eye(len(DRIFT)), drift.T @ (w * s))
        m = drift @ mean
        error, w = np.maximum(q - 2 * m * s + n * m * m, 0), w * w
        normal, right = (square * (w * n)[:, None]).T @ square + np.eye(2), square.T @ (w * error)
        spread = np.linalg.solve(normal, right)
        if spread.min() < 0:                     # the other one alone
            spread = np.where(spread < 0, 0, right / np.diag(normal))
        variance = square @ spread
    return mean, spread, float(x.max())


def _comparable(total: Column, grams: Column, fit: tuple[np.ndarray, np.ndarray, float]) -> Column:
    """The sum ``total`` of so many n-grams, as a score that lengths share."""
    mean, spread, longest = fit
    x = grams / 1000.0
    near = F.least(x, F.lit(longest))
    drift = sum((float(c) * F.pow(near, F.lit(p)) for c, p in zip(mean, DRIFT)), F.lit(0.0))
    drift *= F.greatest(x / longest, F.lit(1.0))
    return F.when(grams > 0, (total - drift) / F.sqrt(1 + float(spread[0]) * x + float(spread[1]) * x * x)).otherwise(0.0)


def _best_cut(scored: DataFrame) -> float | None:
    """The perturbed score that best parts good from other labelled documents.

    Scores are counted in bins of a quarter, at most one a labelled document.
    """
    bins = (scored.groupBy(F.floor(F.col("perturbed") * 4).alias("bin"))
            .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).orderBy("bin").toPandas())
    goods, bads = int(bins["good"].sum()), int(bins["bad"].sum())
    if not goods or not bads:
        return None
    best, at, below_good, below_bad = -1.0, None, 0, 0
    for bin_, good, bad in zip(bins["bin"].tolist(), bins["good"].tolist(), bins["bad"].tolist()):
        if below_good > (1 - KEEP_GOOD) * goods and at is not None:
            break
        value = below_bad / bads - below_good / goods
        if value > best:
            best, at = value, bin_ / 4
        below_good, below_bad = below_good + good, below_bad + bad
    return at


def _kth(perturbed: DataFrame, k: int) -> float:
    """The k-th largest value (to 2^-20), on counts of at most 1024 ranges a pass."""
    ranked = kept(perturbed.select(F.floor(F.col("perturbed") * float(1 << 20)).alias("rank")), "iw-ranks")
    low, high = ranked.agg(F.min("rank"), F.max("rank")).first()
    if k < 1 or low is None:
        return math.inf
    above = 0
    while low < high:
        width = (high - low) // 1024 + 1
        bins = (ranked.where(F.col("rank").between(low, high))
                .groupBy(F.expr(f"(rank - {low}) div {width}").alias("bin")).count()
                .orderBy(F.desc("bin")).collect())
        for r in bins:
            if above + r["count"] >= k or r is bins[-1]:
                low, high = low + r["bin"] * width, min(high, low + (r["bin"] + 1) * width - 1)
                break
            above += r["count"]
    return low / float(1 << 20)


def importance_resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 11,
                        id_col: str = "doc_id", text_col: str = "text", bits: int | None = None
                        ) -> tuple[DataFrame, str, str]:
    """All rows and columns of ``docs`` with a score and whether it is chosen;
    and the names of those two columns (``score`` and ``chosen``, with ``_``
    added while the input has them).

    ``labels``: doc_id, quality, toxic.  ``k``: how many documents to choose.
    ``bits``: of a bucket's number, if not as many as the texts ask for.
    """
    names = {"text": text_col}
    for own in ("label", "score", "chosen", "known_id", "grams"):
        names[own] = unused(docs, own, *names.values())
    known = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(names["known_id"]))
             .agg(F.min(F.coalesce(((F.col("quality") == 1) & (F.col("toxic") == 0)), F.lit(False)).cast("int"))
                  .alias(names["label"])))
    known = kept(known, "iw-labels")
    total = known.count()
    if total > LABELLED:
        # the ids whose hash falls in the first LABELLED of `total` parts
        hashed = F.expr(f"pmod(xxhash64(`{names['known_id']}`, 3), 1000000)")
        known = known.where(hashed < 1_000_000 * LABELLED // total)
    # bounded by LABELLED, so it may be sent to every task
    rows = docs.join(F.broadcast(known), col(id_col) == col(names["known_id"]), "left").drop(names["known_id"])
    rows = rows.withColumn(names["score"], F.lit(0.0)).withColumn(names["grams"], F.lit(0).cast("long"))

    texts = rows.select(col(text_col).alias("text"), col(names["label"]).alias("label"))
    if bits is None:
        bits = bits_for(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    counts = kept(texts.mapInArrow(_counts(bits), "bucket int, raw long, target long").groupBy("bucket")
                  .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")), "iw-counts")
    all_raw, all_target = counts.agg(F.sum("raw"), F.sum("target")).first()
    share = (all_target or 0) / (all_raw or 1)
    # buckets whose weight is not 0, with or without one document
    t, e = F.col("target") + PRIOR, F.col("raw") * share + PRIOR
    sure = F.abs(F.log(t / e)) > (SHRINK - 0.5) * F.sqrt(1 / t + 1 / e)
    model = counts.where(F.lit(share > 0) & sure).toPandas()
    raw, target = (model[c].to_numpy(np.float64) for c in ("raw", "target"))
    level = float((target * _weight(target, raw * share)).sum() / max(all_target or 0, 1))
    score = _scores(names, bits, model["bucket"].to_numpy(np.int64), raw, target, share, level)

    judged = kept(map_rows(rows.where(col(names["label"]).isNotNull()), score).select(
        col(id_col).alias("id"), col(names["label"]).alias("label"), col(names["score"]).alias("score"),
        col(names["grams"]).alias("grams")), "iw-judged")
    fit = _length_fit(judged)
    scored = map_rows(rows, score)
    scored = scored.withColumn(names["score"], _comparable(scored[names["score"]], scored[names["grams"]], fit))
    perturbed = col(names["score"]) + _gumbel(col(id_col), seed)
    if k is not None:
        cut = _kth(scored.select(perturbed.alias("perturbed")), k)
    else:
        cut = _best_cut(judged.select("label", (_comparable(F.col("score"), F.col("grams"), fit)
                                                + _gumbel(F.col("id"), seed)).alias("perturbed")))
    chosen = F.lit(True) if cut is None else perturbed >= cut
    return (scored.withColumn(names["chosen"], chosen).drop(names["label"], names["grams"]),
            names["score"], names["chosen"])


def resampled(docs: DataFrame, labels: DataFrame, k: int | None = None, **options) -> DataFrame:
    """The chosen rows of ``docs``."""
    out, _, chosen = importance_resample(docs, labels, k, **options)
    return out.where(col(chosen)).select(*map(col, docs.columns))
