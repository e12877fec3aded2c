"""Name repair, quantile sketches and counts taken while writing."""
import random

import pytest
from pyspark.sql import functions as F

from barrio.operators import names, sketches
from barrio.operators.quality import observed_write

from conftest import rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_match(name, known):
    key, fold = name.strip(" ").lower(), None
    fold = key.translate(str.maketrans(*names._accents()))
    folds = {}
    for k in sorted(known, reverse=True):
        folds[k.strip(" ").lower().translate(str.maketrans(*names._accents()))] = k
    exact = [k for k in known if k.strip(" ").lower() == key]
    if exact:
        return min(exact), "exact"
    if fold in folds:
        return folds[fold], "folded"
    allowed = min(3, len(fold) // 4)
    near = [(distance(fold, f), k) for f, k in folds.items() if abs(len(f) - len(fold)) <= allowed]
    near = [x for x in near if x[0] <= allowed and allowed]
    return (min(near)[1], "edited") if near else (None, "unmatched")


def test_matches_equal_all_pairs(spark):
    rng = random.Random(4)
    known = ["el Raval", "la Sagrera", "Sant Antoni", "Sant Andreu", "Sants", "Sants - Badal", "Poble-sec", "Poblenou",
             "el Poblenou", "Vallvidrera", "Horta", "la Font d'en Fargues", "Can Baró", "Can Peguera", "Aa"]
    found = set(known)
    for name in known:
        for _ in range(25):
            t = list(name)
            for _ in range(rng.randrange(1, 5)):
                at, kind = rng.randrange(len(t) or 1), rng.randrange(4)
                if kind == 0 and t:
                    del t[at]
                elif kind == 1:
                    t.insert(at, rng.choice("aeiou -'"))
                elif kind == 2 and t:
                    t[at] = rng.choice("aeiosàéò")
                elif t:
                    t[at] = t[at].upper()
            found.add("".join(t))
    found |= {"", " ", "  HORTA ", "hórtà", "nowhere at all", "x"}
    df = spark.createDataFrame([(n,) for n in sorted(found)] + [(None,)], "name string")
    got = {r.name: (r.area, r.how) for r in names.matches(df, spark.createDataFrame([(k,) for k in known], "name string")).collect()}
    assert got.pop(None) == (None, "unmatched")
    assert got == {n: plain_match(n, known) for n in found}
    assert {h for _, h in got.values()} == {"exact", "folded", "edited", "unmatched"}


def test_rows_keep_their_columns_and_unmatched_ones_are_reported(spark):
    known = spark.createDataFrame([("Alpha",), ("Beta",)], "name string")
    data = spark.createDataFrame([(1, "alpha "), (2, "Alpah"), (3, "Gamma"), (4, None), (3, "Gamma"), (5, "béta")],
                                 "k int, neighborhood_name string")
    out, report = names.repaired(data, known)
    assert rows(out) == [(1, "Alpha"), (2, None), (3, None), (3, None), (4, None), (5, "Beta")]    # one edit in five letters
    assert {(r.name, r.how, r.rows) for r in report.collect()} == {
        ("alpha ", "exact", 1), ("Alpah", "unmatched", 1), ("Gamma", "unmatched", 2), (None, "unmatched", 1), ("béta", "folded", 1)}


def test_merged_sketches_rank_as_exact_ones(spark):
    df = spark.range(20000).selectExpr("id % 7 AS year", "pow(id % 5003, 1.5) AS v").unionByName(
        spark.createDataFrame([(1, None), (9, None)], "year long, v double"))
    stored = sketches.sketches(df, ["year"], "v")
    assert {r.year: r._n for r in stored.collect()} == {y: r for y, r in
                                                       [(r.year, r["count"]) for r in df.where("v IS NOT NULL").groupBy("year").count().collect()]}
    cuts = sketches.sketch_cuts(stored)
    for p, cut in zip((0.33, 0.67), cuts):
        low, high = df.where("v IS NOT NULL").agg(F.avg((F.col("v") < cut).cast("double")), F.avg((F.col("v") <= cut).cast("double"))).first()
        assert low - 2 * sketches.rank_error() <= p <= high + 2 * sketches.rank_error()
    with pytest.raises(ValueError):
        sketches.sketch_cuts(stored.limit(0))


def test_counts_come_with_the_write(spark, tmp):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (2, None)], "k int, v double")
    counts = observed_write(df, {"no key": F.col("k").isNull(), "small": F.col("v") < 2}, lambda x: x.write.parquet(f"{tmp}/o"))
    assert counts == {"rows": 3, "no key": 1, "small": 1} and spark.read.parquet(f"{tmp}/o").count() == 3
    # one scan: the counts are part of the write's own plan
    watched = df.observe("q", F.count(F.lit(1)).alias("n"))
    assert watched._jdf.queryExecution().executedPlan().toString().count("Scan") == df._jdf.queryExecution().executedPlan().toString().count("Scan")
