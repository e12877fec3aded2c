"""Mixing sources to target weights by Pareto order sampling.

Targets.  Sources in code-point order (null last) weigh 5, 2, 1, repeating,
and share ``share`` times all words.  No target passes ``cap`` times its
source's words: what is over goes to the others by weight until none is above
(sources by cap over weight; the full ones are a prefix of that order).

Copies.  A document is expected in e = target / source words copies (times
its weight over the source's mean weight, where a weight is given; ``cap`` at
most).  floor(e) copies are certain.  The rest of e is the inclusion
probability p of one copy more: documents are ranked by random odds over
inclusion odds, [u / (1 - u)] / [p / (1 - p)], and the smallest are taken, so
many that their words come nearest to the rest of the target.  u is a hash of
the id and the seed: reruns and recomputed partitions agree.

The nearest rank is found without sorting a source in one task: the rank
value is a 52-bit number; words are summed by its leading bits (map-side),
the leading bits where a source's rest is reached are kept, and ten more bits
are looked at until few documents share them.  Only those are ordered.

A null text has size 0; such documents and those without words are taken 0
times.  A row without an id hashes its text, so such rows are spread as others
are.  Rows that repeat an id have equal u and are ordered by size.  An empty table gives an empty result.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barrio.llm.tables import col, kept

WEIGHTS = (5, 2, 1)
BITS, STEP, ENOUGH = 52, 10, 10_000
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """key, source_size, target of every source; one row each, so few rows."""
    per = sizes.groupBy("key").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"))
    ranked = (per.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
              .withColumn("w", F.element_at(F.array(*map(F.lit, weights)),
                                            (F.col("n") % len(weights) + 1).cast("int")).cast("double"))
              .withColumn("most", F.col("source_size") * F.lit(float(cap))))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("w"), "n").rowsBetween(Window.unboundedPreceding, -1)
    filled = (ranked.withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("all_w", F.sum("w").over(everything))
              .withColumn("level", (F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                          / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
              .withColumn("full", F.col("most") <= F.col("w") * F.col("level")))
    over = lambda c: F.sum(F.when(F.col("full"), F.col(c)).otherwise(0.0)).over(everything)
    return (filled.withColumn("left_words", F.col("all_words") - over("most"))
            .withColumn("left_w", F.col("all_w") - over("w"))
            .select("key", "source_size",
                    F.when(F.col("full"), F.col("most"))
                    .otherwise(F.col("w") * (F.col("left_words") / F.expr("nullif(left_w, 0)"))).alias("target")))


def _uniform(seed: int) -> Column:
    """A number inside (0, 1) from the document's id, of one without from its text."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.col("digest")), F.lit(f"|mix|{seed}"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << BITS)


def mix(docs: DataFrame, share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = WEIGHTS,
        weight: Column | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row.

    ``weight``: a positive column of ``docs``; by default all documents of a
    source are alike.
    """
    sizes = docs.select(
        col(id_col).alias("doc_id"), col(source_col).alias("source"),
        F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight"),
        F.when(col(id_col).isNull(), F.md5(F.coalesce(col(text_col), F.lit("")))).alias("digest"))
    sizes = kept(sizes.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "mix-sizes")
    targets = kept(source_targets(sizes, share, cap, weights), "mix-targets")
    rows = sizes.join(targets, "key")
    expected = F.col("target") / F.expr("nullif(source_size, 0)")
    if weight is not None:
        mean = kept(sizes.groupBy("key").agg((F.sum(F.col("weight") * F.col("size")) / F.expr("nullif(sum(size), 0)"))
                                             .alias("mean")), "mix-weights")
        rows = rows.join(mean, "key")
        expected = F.least(expected * F.col("weight") / F.col("mean"), F.lit(float(cap)))
    odds = F.col("p") / (1 - F.col("p"))
    rows = kept(
        rows.withColumn("e", F.coalesce(expected, F.lit(0.0))).withColumn("whole", F.floor("e"))
        .withColumn("p", F.col("e") - F.col("whole")).withColumn("u", _uniform(seed))
        .withColumn("q", F.when((F.col("p") > 0) & (F.col("size") > 0), (F.col("u") / (1 - F.col("u"))) / odds))
        .withColumn("rank", F.floor(F.col("q") / (1 + F.col("q")) * float(1 << BITS)))
        .select("doc_id", "source", "key", "size", "source_size", "target", "whole", "rank"), "mix-ranks")

    # by source: the leading bits of the rank at which the rest is reached
    cut = (rows.groupBy("key").agg((F.min("target") - F.sum(F.col("whole") * F.col("size"))).alias("rest"))
           .withColumn("lead", F.lit(0).cast("long")).withColumn("reached", F.lit(0).cast("long")))
    cut = kept(cut, "mix-cut")
    shift = BITS
    while True:
        low = max(0, shift - STEP)
        inside = (rows.where("rank IS NOT NULL").withColumn("lead", F.shiftright("rank", shift))
                  .join(cut, ["key", "lead"]))
        bins = (inside.withColumn("next", F.shiftright("rank", low)).groupBy("key", "next")
                .agg(F.sum("size").alias("words"), F.count("*").alias("n"),
                     F.min("rest").alias("rest"), F.min("reached").alias("reached")))
        # at most 2^STEP rows of a source
        run = Window.partitionBy("key").orderBy("next")
        bins = (bins.withColumn("until", F.col("reached") + F.sum("words").over(run))
                .withColumn("before", F.col("until") - F.col("words"))
                .withColumn("past", F.col("until") >= F.col("rest")))
        at = (bins.groupBy("key").agg(
            F.coalesce(F.min(F.when(F.col("past"), F.struct("next", "before", "n"))),
                       F.max(F.struct("next", "before", "n"))).alias("at"), F.min("rest").alias("rest")))
        # a source without ranked documents keeps its row
        cut = kept(cut.select("key").join(
            at.select("key", "rest", F.col("at.next").alias("lead"), F.col("at.before").alias("reached"),
                      F.col("at.n").alias("n")), "key", "left"), "mix-cut")
        shift = low
        if not shift or not cut.where(F.col("n") > ENOUGH).limit(1).count():
            break
    ranked = rows.join(cut.select("key", "lead", "rest", "reached"), "key")
    lead = F.shiftright("rank", shift)
    near = (ranked.where(lead == F.col("lead"))
            .withColumn("until", F.col("reached") + F.sum("size").over(
                Window.partitionBy("key").orderBy("rank", "doc_id", "size")
                .rowsBetween(Window.unboundedPreceding, 0)))
            # the document that crosses the rest stays if it ends no farther from it
            .withColumn("more", (2 * F.col("until") - F.col("size") <= 2 * F.col("rest")).cast("long")))
    far = (ranked.where(F.col("rank").isNull() | F.col("lead").isNull() | (lead != F.col("lead")))
           .withColumn("more", F.coalesce((lead < F.col("lead")).cast("long"), F.lit(0))))
    cols = ["doc_id", "source", "size", "source_size", "target", "whole", "more"]
    return (near.select(cols).unionByName(far.select(cols))
            .withColumn("target", F.coalesce("target", F.lit(0.0)))
            .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.col("more")).otherwise(0).cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size")).drop("whole", "more"))


def oracle(share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 7) -> str:
    """The same mix (without document weights) in DuckDB SQL over ``documents``."""
    return f"""
WITH sizes AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS key, source, md5(coalesce(text, '')) AS digest,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT key, min(source) AS source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY key),
ranked AS (
  SELECT *, source_size * {float(cap)}::DOUBLE AS most, {list(weights)}[(n % {len(weights)} + 1)::INT]::DOUBLE AS w
  FROM (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS n FROM per)),
filled AS (
  SELECT *, most <= w * level AS is_full FROM (
    SELECT *, sum(source_size) OVER ()::DOUBLE * {float(share)}::DOUBLE AS all_words, sum(w) OVER () AS all_w,
           (sum(source_size) OVER ()::DOUBLE * {float(share)}::DOUBLE - coalesce(sum(most) OVER before, 0.0::DOUBLE))
           / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0::DOUBLE)) AS level
    FROM ranked
    WINDOW before AS (ORDER BY most / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
targets AS (
  SELECT key, source_size, CASE WHEN is_full THEN most ELSE w * (
    (all_words - sum(CASE WHEN is_full THEN most ELSE 0.0::DOUBLE END) OVER ())
    / nullif(all_w - sum(CASE WHEN is_full THEN w ELSE 0.0::DOUBLE END) OVER (), 0)) END AS target FROM filled),
shares AS (
  SELECT *, e - whole AS p FROM (
    SELECT *, floor(e)::BIGINT AS whole FROM (
      SELECT *, coalesce(target / nullif(source_size, 0), 0.0::DOUBLE) AS e FROM sizes JOIN targets USING (key)))),
odds AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM (
    SELECT *, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, digest) || '|mix|{seed}'), 1, 13))::BIGINT::DOUBLE
               + 0.5::DOUBLE) / {1 << BITS}::DOUBLE AS u FROM shares)),
ordered AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY key) AS rest,
         sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (
           PARTITION BY key ORDER BY q IS NULL, floor(q / (1 + q) * {1 << BITS}::DOUBLE), doc_id, size
           ROWS UNBOUNDED PRECEDING) AS until
  FROM odds)
SELECT doc_id, size, source_size, coalesce(target, 0.0::DOUBLE) AS target,
       (CASE WHEN size > 0 THEN whole + CASE WHEN q IS NOT NULL AND 2 * until - size <= 2 * rest THEN 1 ELSE 0 END
        ELSE 0 END * size)::BIGINT AS taken
FROM ordered"""
