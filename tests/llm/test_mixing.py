import duckdb
import pandas as pd
from pyspark.sql import functions as F

from barrio.llm import mixing as M
from tests.llm.helpers import SCHEMA, odd_rows


def targets(sizes, share=1.5, cap=2, weights=(5, 2, 1)):
    """Shares again and again what is over."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_w = sum(w[s] for s in order if s not in full)
        got = {s: cap * sizes[s] if s in full else rest * w[s] / open_w for s in order}
        over = {s for s in order if s not in full and got[s] >= cap * sizes[s]}
        if not over:
            return got
        full |= over


def test_equals_sql_and_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(M, "ENOUGH", 3)            # look at more and more bits
    rows = odd_rows(9)
    got = M.mix(spark.createDataFrame(rows, SCHEMA)).toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"),
                                            "text": [r[1] for r in rows], "source": [r[2] for r in rows]}))
    want = con.execute(M.oracle()).fetchall()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    mine = [tuple(None if pd.isna(x) else x for x in r) for r in got[cols].itertuples(index=False)]
    assert sorted(mine, key=key) == sorted(want, key=key)
    sizes = {}
    for _, t, s, _ in rows:
        import re
        sizes[s] = sizes.get(s, 0) + len(re.findall(M.WORD, t or ""))
    expect = targets(sizes)
    assert (got.taken <= 2 * got["size"]).all()
    for s, part in got.groupby(got.source.fillna("none")):
        s = None if s == "none" else s
        assert abs(part.target.iloc[0] - expect[s]) < 1e-6 * max(1, expect[s])
        # whole documents: at most half the largest one off
        assert abs(part.taken.sum() - expect[s]) <= part["size"].max() / 2 + 1


def test_weights_are_unequal_odds(spark):
    rows = [(i, "w " * 10, "a", 1.0 if i % 2 else 3.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    got = M.mix(df, share=0.5, weights=(1,), weight=F.col("weight")).toPandas()
    assert abs(got.taken.sum() - 20000) <= 10
    heavy, light = (got[got.doc_id % 2 == r].copies.mean() for r in (0, 1))
    assert abs(heavy - 0.75) < 0.04 and abs(light - 0.25) < 0.04


def test_reruns_and_partitions_agree(spark):
    df = spark.createDataFrame(odd_rows(2), SCHEMA)
    a, b = (sorted(map(str, M.mix(x).collect())) for x in (df.repartition(7), df.coalesce(1)))
    assert a == b


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
