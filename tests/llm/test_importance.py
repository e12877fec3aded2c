import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barrio.llm import importance as I
from barrio.llm.words import text_buffer
from tests.llm.helpers import SCHEMA, odd_rows

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    """Clean prose, shouted and decorated junk, and prose with toxic words."""
    rng = random.Random(seed)
    words = [a + b for a in "ba do fi gu ke lo ma ne".split() for b in "ra ni to mu se ti po".split()]
    rows, labels = [], []
    for i in range(n):
        kind = rng.choice(["good"] * 7 + ["shout", "mark", "toxic"])
        w = [rng.choice(words) for _ in range(rng.choice([8, 40, 200]))]
        if kind == "shout":
            w = [x.upper() + "!!" for x in w]
        elif kind == "mark":
            w = [x + "$$$" for x in w]
        elif kind == "toxic":
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vilething", "vilestuff"]))
        rows.append((i, " ".join(w), kind, "x"))
        if rng.random() < 0.5:
            labels.append((i, int(kind in ("good", "toxic")), int(kind == "toxic")))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, chosen string")
    out, score, chosen = I.importance_resample(docs, spark.createDataFrame(labels, LABELS))
    assert out.columns == docs.columns + [score, chosen] and chosen == "chosen_"
    known = {i for i, *_ in labels}
    got = [(r.kind == "good", r[chosen]) for r in out.collect() if r.doc_id not in known]
    good, bad = [c for g, c in got if g], [c for g, c in got if not g]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1
    kept = I.resampled(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns and kept.count() == out.where(F.col(chosen)).count()


def test_top_k_is_of_the_perturbed_scores(spark):
    rows, labels = corpus(400, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, x string")
    out, score, chosen = I.importance_resample(docs, spark.createDataFrame(labels, LABELS), k=123)
    got = out.withColumn("p", F.floor((F.col(score) + I._gumbel(F.col("doc_id"), 11)) * float(1 << 20))).collect()
    assert sum(r[chosen] for r in got) == 123
    assert min(r.p for r in got if r[chosen]) > max(r.p for r in got if not r[chosen])


def test_gumbel_is_gumbel(spark):
    x = np.array([r.g for r in spark.range(20000).select(I._gumbel(F.col("id"), 1).alias("g")).collect()])
    assert abs(x.mean() - 0.5772) < 0.03 and abs(x.std() - np.pi / np.sqrt(6)) < 0.03


def test_ngrams_are_distinct_and_by_document():
    data, offsets = text_buffer(pa.array(["One two, two ONE", "", None, "one two two one", "!! !!"]))
    bucket, doc = I.ngrams(data, offsets)
    sets = {d: set(bucket[doc == d].tolist()) for d in range(5)}
    assert len(bucket) == sum(map(len, sets.values())) and not sets[1] and not sets[2] and sets[4]
    assert len(sets[0] & sets[3]) >= 4 and sets[0] != sets[3]       # words and heads agree, shapes do not


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, None), (2, None, 0), (None, 1, 0), (9999, 0, 1), (0, 1, 0),
                                    (4, 0, 0)], LABELS)
    out, score, chosen = I.importance_resample(docs, labels)
    assert out.count() == len(odd_rows()) and score == "score_"
    assert out.where("text IS NULL OR trim(text) = ''").where(f"{score} <> 0").count() == 0
    none = I.resampled(docs, labels.limit(0))
    assert sorted(map(str, none.collect())) == sorted(map(str, docs.collect()))
    assert I.resampled(docs.limit(0), labels).count() == 0 and I.resampled(docs, labels, k=0).count() == 0


def test_clean_documents_stay_at_every_length(spark):
    """Long texts hold rare words that few labelled texts have."""
    rng = np.random.default_rng(7)
    share = 1 / np.arange(1, 40001) ** 1.05
    words = np.array([f"{'ba do fi gu ke lo ma ne'.split()[i % 8]}{i:x}".translate(str.maketrans("0123456789", "ghijklmnop"))
                      for i in range(len(share))])
    rows, labels = [], []
    for i in range(3000):
        size = int(rng.choice([30, 150, 600, 2500, 9000], p=[0.3, 0.38, 0.2, 0.08, 0.04]))
        w = words[rng.choice(len(words), size, p=share / share.sum())]
        kind = rng.choice(["good", "junk", "toxic"], p=[0.7, 0.15, 0.15])
        if kind == "junk":
            w = np.char.add(w, "$$$")
        elif kind == "toxic":
            at = rng.choice(size, max(3, size // 50), replace=False)
            w = w.astype(object)
            w[at] = rng.choice(["vilething", "vilestuff", "vilename"], len(at))
        rows.append((i, " ".join(w), str(kind), size))
        if rng.random() < 0.5:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, size int").repartition(8)
    out, _, chosen = I.importance_resample(docs, spark.createDataFrame(labels, LABELS))
    got = out.groupBy("size", "kind").agg(F.avg(F.col(chosen).cast("int")).alias("kept")).collect()
    for r in got:
        assert r.kept >= 0.96 if r.kind == "good" else r.kept < 0.1, sorted(map(tuple, got))


def test_cut_below_any_fixed_range(spark):
    scored = spark.createDataFrame([(1, -900.0 - i) for i in range(50)] + [(0, -2000.0 - i) for i in range(50)],
                                   "label int, perturbed double")
    assert -1951 < I._best_cut(scored) <= -949


def test_more_buckets_for_more_text():
    gb = 1 << 30
    assert [I.bits_for(n) for n in (0, gb, gb + 1, 4 * gb, 16 * gb, 10 ** 9 * gb)] == [20, 20, 21, 21, 22, 28]


def test_scores_do_not_depend_on_how_counts_are_held(spark, monkeypatch):
    """Sparse counts and a searched model give what arrays give."""
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")

    monkeypatch.setattr(I, "SHRINK", 0.0)             # so that few labels give weights

    def scores():
        out, score, _ = I.importance_resample(docs, labels, bits=20)
        return sorted((str(r.doc_id), r.text or "", round(r[score], 6)) for r in out.collect())
    dense = scores()
    monkeypatch.setattr(I, "DENSE_BITS", 10)
    assert scores() == dense and any(x[2] for x in dense)
