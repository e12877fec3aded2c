"""A training-data pipeline over ``documents``: five stages, one operator each.

Every stage takes what its predecessor kept, written as Parquet and read
again, and its decisions take effect.  All but the last return the columns of
``documents``; the last adds ``copies``, how often the mix holds a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.llm import decontam, importance, mixing, near_dedup, pii
from barrio.llm.tables import col, kept, table, unused


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what importance resampling rejects (junk and toxic documents).

    Null and empty texts score 0, as a text without known words, and stay or go
    as such; rows with an equal id and text share their fate, as do scores that
    tie at the cut; without labels of both kinds every row stays.  An empty
    table stays empty."""
    return importance.resampled(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies (five words, similarity
    0.8).

    Rows without an id stay, as do all rows of an id that is kept; documents
    without words are copies of nothing and stay.  An empty table stays empty."""
    copies = near_dedup.near_duplicates(docs, percent=80).where("NOT kept").select("doc_id")
    # one plan at every size: the copies grow with the documents
    return docs.join(copies.hint("merge"), "doc_id", "left_anti").select(*map(col, docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Null, empty and short texts hold none and stay; rows are judged each, so
    repeated rows go or stay together.  Without items every row stays.  An
    empty table stays empty."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data; ``n_chars`` follows the new text.

    Every row stays.  A null text stays null and its ``n_chars`` too, as does a
    null ``n_chars``; equal values get equal pseudonyms in all rows.  An empty
    table stays empty."""
    return pii.pseudonymised(docs, pii.key_of(spark)).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
        .when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each with its number of copies (``copies``,
    with ``_`` added while the input has it).

    Documents without words are taken 0 times and go.  A null id counts as an
    id of its own; rows that repeat an id get the largest of its copies.  Of
    equal ranks the smaller id is taken.  An empty table stays empty."""
    mixed_id, copies = unused(docs, "mixed_id"), unused(docs, "copies")
    taken = (mixing.mix(docs).where("copies > 0").groupBy(F.col("doc_id").alias(mixed_id))
             .agg(F.max("copies").alias(copies)))
    both = docs.join(taken, F.col("doc_id").eqNullSafe(col(mixed_id)))
    return both.select(*map(col, docs.columns), col(copies))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pseudonyms", pseudonyms),
    ("mix", mix),
]

#: Hashed models, signatures and alignments are not SQL: the stages are tested
#: one by one, against brute force where a plain way gives the same rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
