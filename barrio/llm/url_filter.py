"""URL verdicts: rules, and naive Bayes over segmented host and path tokens.

Rules first.  A rule (host, then a path) fits its host and all subdomains when
the url's path starts with the rule's; the longest rule wins (of equally long
ones that with the longer host, then block).

Other urls.  Host labels are cut at everything but letters, and each piece is
segmented into words by a unigram Viterbi: the cut with the largest product
of word probabilities, any substring having at least
10 / (N * 10 ** length), also outside the vocabulary.  N is ``CORPUS`` words whatever the input: counts are
scaled to it, and the seed words and their inflected forms have at least the
share ``SEED_SHARE``, so cuts do not change with the size of a table.  A seed
of four letters and more is a word beside an unknown one, a shorter one only
beside known words.  Substrings meet the vocabulary in a join (distinct
pieces only), so the vocabulary is neither capped nor sent to tasks; a piece's
known substrings are then cut in a small per-row function.  Words have 1 to 63
letters, as a host's labels have.  A multinomial naive Bayes model scores host words and path
tokens (numbers are one token).  It is trained here on all urls: block
examples are those whose host words hold a seed word or a form of it, allow examples all
others; token counts are map-side combined sums and the model is joined with
distinct hosts and distinct paths.  A url is blocked when the block class is
the more probable.

A host holding a third of all pages is one host row; pages meet hosts and
paths in joins that adaptive execution splits.  Host: after the first ``://``
up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: from there up to ``?``
or ``#``.  Null urls and those without ``://`` have both empty: no rule fits and
they get the prior's verdict.  Ids are only passed on, so null and repeated
ones are as any others.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import kept, picked

LONGEST = 63                 # no label of a host is longer, so no word is
SPAN = 512                   # letters of a piece whose substrings are made at a time
CORPUS, SEED_SHARE = 1_000_000, 2e-4
# Words whose presence in a host marks a block example.
SEEDS = ("adult", "bet", "casino", "cheap", "escort", "gambling", "hack", "malware", "phishing", "pills", "poker",
         "porn", "spam", "torrent", "viagra", "warez", "xxx")


def inflected(seeds: tuple[str, ...]) -> tuple[str, ...]:
    """Seeds with their plurals, verb forms and (but for short ones) agents."""
    forms = set(seeds)
    for seed in seeds:
        endings = ["s", "ed", "ing"] + ["er", "ers"] * (len(seed) > 3)
        stems = {seed}
        if re.search("[^aeiou][aeiou][^aeiouwxy]$", seed):
            stems.add(seed + seed[-1])
        if seed.endswith("ing") and len(seed) > 6:
            stems = {seed[:-3]}
            forms |= {seed[:-3], seed[:-3] + "e", seed[:-3] + "es"}
        if seed.endswith("s") and len(seed) > 4:
            stems = {seed[:-1]}
            forms.add(seed[:-1])
        forms |= {stem + ending for stem in stems for ending in endings}
        if len(stems) > 1:
            forms.discard(seed + seed[-1] + "s")
    return tuple(sorted(forms))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, both empty without ``://``."""
    rest = F.when(url.contains("://"), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    lowered = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                          "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _rules_of(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """host, rules: the rules of each distinct host and its parents."""
    spark = hosts.sparkSession
    table = spark.createDataFrame(
        [(rule[:rule.index("/")], rule[rule.index("/"):], rule, verdict) for verdict, rule in rules],
        "rule_host string, rule_path string, rule string, verdict string")
    parents = hosts.select("host", F.explode(F.expr(
        "transform(sequence(1, size(split(host, '[.]'))), i -> substring_index(host, '.', i - 1 - size(split(host, '[.]'))))"
    )).alias("rule_host"))
    best = F.struct((-F.length("rule")).alias("a"), (-F.length("rule_host")).alias("b"),
                    (F.col("verdict") != "block").alias("c"), "rule", "rule_path", "verdict")
    return parents.join(table, "rule_host").groupBy("host").agg(F.array_sort(F.collect_list(best)).alias("rules"))


def _best_cut(piece: str, known: list[tuple[int, int, float]], total: float) -> list[str]:
    """The cut of a piece into words with the largest product of probabilities.

    ``known``: (place, length, count) of its known substrings.  What is unknown
    costs by its length alone, so the best unknown word that ends at a place
    begins where a running maximum says: linear in letters and known substrings.
    """
    n = len(piece)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for at, length, count in known:
        ends[at + length].append((at, math.log(count / total)))
    unknown, letter = math.log(10 / total), math.log(10)
    best, back = [0.0] * (n + 1), [0] * (n + 1)
    high, high_at = 0.0, 0                       # the largest best[at] + at * letter
    for end in range(1, n + 1):
        p, start = high + unknown - end * letter, high_at
        for at, log_p in ends[end]:
            if best[at] + log_p >= p:
                p, start = best[at] + log_p, at
        best[end], back[end] = p, start
        if p + end * letter > high:
            high, high_at = p + end * letter, end
    cut, end = [], n
    while end:
        cut.append(piece[back[end]:end])
        end = back[end]
    return cut[::-1]


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Viterbi over each piece's known substrings."""
    for batch in batches:
        pieces, words = batch.column("piece").to_pylist(), []
        for piece, known, total in zip(pieces, batch.column("known").to_pylist(), batch.column("total").to_pylist()):
            words.append(_best_cut(piece, [(k["at"], k["length"], k["n"]) for k in known or ()], max(total, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(words, pa.list_(pa.string()))],
                                         names=["piece", "words"])


def host_words(hosts: DataFrame, vocabulary: DataFrame, seeds: tuple[str, ...] = ()) -> DataFrame:
    """host, words of distinct hosts.  ``vocabulary``: word, n.  ``seeds`` are
    words at least as common as ``SEED_SHARE``."""
    pieces = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("place", "piece")).where("piece <> ''")
    distinct = kept(pieces.select("piece").distinct(), "url-pieces")
    # a row for each SPAN letters of a piece: a long one is no long row
    spans = distinct.select("piece", F.explode(F.expr(f"sequence(0, (length(piece) - 1) div {SPAN})")).alias("span"))
    spans = spans.select("piece", (F.col("span") * SPAN).alias("first"), F.expr(
        f"substring(piece, cast(span * {SPAN} + 1 AS int), {SPAN} + {LONGEST} - 1)").alias("letters"),
        F.expr(f"least({SPAN}, length(piece) - span * {SPAN})").alias("starts"))
    parts = spans.select("piece", F.explode(F.expr(f"""flatten(transform(sequence(0, cast(starts - 1 AS int)), i ->
        transform(sequence(1, least({LONGEST}, length(letters) - i)), n ->
            named_struct('at', cast(first AS int) + i, 'length', n, 'word', substring(letters, i + 1, n)))))""")).alias("s"))
    vocabulary = kept(vocabulary.groupBy("word").agg(F.sum("n").alias("n")), "url-vocabulary")
    total = vocabulary.agg(F.sum("n")).first()[0] or 1
    scaled = F.col("n") * (CORPUS / float(total))
    vocabulary = vocabulary.select("word", F.when(
        F.col("word").isin(*seeds), F.greatest(scaled, F.lit(SEED_SHARE * CORPUS))).otherwise(scaled).alias("n"))
    known = (parts.select("piece", "s.*").join(vocabulary, "word").groupBy("piece")
             .agg(F.collect_list(F.struct("at", "length", "n")).alias("known")))
    cut = (distinct.join(known, "piece", "left").withColumn("total", F.lit(CORPUS))
           .mapInArrow(_segment, "piece string, words array<string>"))
    # a host has at most as many pieces as letters
    found = pieces.join(cut, "piece").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda s: s["words"]))
        .alias("words"))
    return hosts.join(found, "host", "left").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>")))


def _path_tokens(path: Column) -> Column:
    tokens = F.split(F.regexp_replace(F.lower(path), "[0-9]+", " 0 "), "[^a-z0]+")
    return F.filter(F.transform(tokens, lambda t: F.concat(F.lit("/"), t)), lambda t: t != "/")


def judged(pages: DataFrame, rules: list[tuple[str, str]], vocabulary: DataFrame,
           seeds: tuple[str, ...] = SEEDS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, words, score of every page.

    ``rules``: (verdict, rule), a rule being a host and a path from its ``/``.
    ``score``: log odds of the block class.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    rows = kept(picked(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path")),
                "url-pages")
    urls = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    # seeds are words of the language
    forms = inflected(seeds)
    seed_words = spark.createDataFrame([(s, 0) for s in forms], "word string, n long")
    hosts = kept(host_words(rows.select("host").distinct(), vocabulary.unionByName(seed_words), forms).withColumn(
        "block", F.arrays_overlap("words", F.array(*map(F.lit, forms)))), "url-hosts")

    counted = kept(urls.join(hosts, "host").select(
        "n", "block", F.concat("words", _path_tokens(F.col("path"))).alias("tokens")), "url-counted")
    # a token's count in each class
    model = kept(counted.select("n", "block", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum(F.when(F.col("block"), F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("block"), 0).otherwise(F.col("n"))).alias("good")), "url-model")
    tokens, bad, good = model.agg(F.count("*"), F.sum("bad"), F.sum("good")).first()
    bad_urls, good_urls = counted.agg(F.sum(F.when(F.col("block"), F.col("n"))),
                                      F.sum(F.when(~F.col("block"), F.col("n")))).first()
    prior = math.log(((bad_urls or 0) + 1) / ((good_urls or 0) + 1))
    odds = model.select("token", (
        F.log((F.col("bad") + 1) / float((bad or 0) + tokens + 1))
        - F.log((F.col("good") + 1) / float((good or 0) + tokens + 1))).alias("odds"))

    def scored(keys: DataFrame, key: str, tokens: Column) -> DataFrame:
        each = keys.select(key, F.explode(tokens).alias("token")).join(odds, "token")
        return each.groupBy(key).agg(F.sum("odds").alias(f"{key}_score"))

    by_host = kept(hosts.select("host", "words").join(scored(hosts, "host", F.col("words")), "host", "left")
                   .join(_rules_of(hosts.select("host"), rules), "host", "left"), "url-host-scores")
    paths = rows.select("path").distinct()
    by_path = kept(scored(paths, "path", _path_tokens(F.col("path"))), "url-path-scores")
    score = F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    fits = F.expr("get(filter(rules, r -> startswith(path, r.rule_path)), 0)")
    return (rows.join(by_host, "host").join(by_path, "path", "left")
            .withColumn("score", score).withColumn("fit", fits)
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), F.when(F.col("score") > 0, "block").otherwise("allow"))
                    .alias("verdict"), "words", "score"))
