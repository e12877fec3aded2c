"""Registered queries of this package: name -> (Spark builder, DuckDB SQL)."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.llm import (decontam, importance, mixing, near_dedup, neighbours, oracles, oracles_conversations, page_text,
                        pii, prefix_trie, repair, repeats, simhash, token_counts, url_filter)
from barrio.llm.tables import table

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, pii.key_of(spark), count_col="n_found").select("doc_id", "n_found", "text")


@query
def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, score, chosen = importance.importance_resample(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.col(score).alias("score"), F.col(chosen).alias("kept"))


@query
def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = page_text.extracted(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_shared")


# The rules of the query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


@query
def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # the language of the hosts: words of the pages
    words = F.split(F.lower(F.regexp_replace("html", "<[^>]*>", " ")), "[^a-z]+")
    vocabulary = (pages.select(F.explode(words).alias("word")).where(f"length(word) between 1 and {url_filter.LONGEST}")
                  .groupBy("word").agg(F.count("*").alias("n")))
    return url_filter.judged(pages, URL_RULES, vocabulary)


@query
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op8_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.benchmark_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("passages") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("passages.item_id")).alias("item_ids"), "passages")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model).withColumn(
        "over_limit", F.col("n_tokens") > 4096)


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.trie(*prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))
    return (nodes.join(prefix_trie.end_digests(ends), ["a", "b"], "left")
            .withColumn("ends_sha256", F.coalesce("sha256", F.sha2(F.lit(""), 256))).drop("a", "b", "sha256"))


@query
def op12_similar_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    report, pieces = repair.repaired(repair.damaged(turns))
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    every = turns.select("conv_id").distinct()
    return (every.alias("l").join(report.alias("r"), F.expr("l.conv_id <=> r.conv_id"), "left")
            .join(repair.digests(pieces).alias("d"), F.expr("l.conv_id <=> d.conv_id"), "left")
            .select("l.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


ORACLES |= {"op1_nearest_neighbours": oracles.OP1, "op6_repeated_passages": oracles.OP6,
            "op7_near_duplicates": oracles.OP7, "op10_mix_sources": mixing.oracle(),
            "op11_prefix_trie": oracles_conversations.OP11,
            "op13_conversation_repair": oracles_conversations.OP13}
