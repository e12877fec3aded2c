import re

import pytest
from pyspark.sql import functions as F

from barrio.llm import repeats as R
from tests.llm.helpers import SCHEMA, WORDS, odd_rows


def brute(rows):
    words = [(i, re.findall(WORDS, t or "")) for i, t, *_ in rows]
    least = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - 49):
                key = tuple(w[k:k + 50])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and least[tuple(w[k:k + 50])] < i:
                gone[k:k + 50] = [True] * 50
        spans, k = [], 0
        while k < len(w):
            if gone[k]:
                e = k
                while e < len(w) and gone[e]:
                    e += 1
                spans.append((k, e))
                k = e
            k += 1
        out.append((i if i is not None else -1, len(w), tuple(spans), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("group", [4096, 1])
def test_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(R, "GROUP", group)          # 1: every mixed prefix is lengthened
    monkeypatch.setattr(R, "GROUP_WORDS", 500)
    rows = odd_rows(5)
    got = R.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, tuple((s.start, s.end) for s in r.spans),
                   r.kept_text) for r in got) == brute(rows)
    assert any(r.spans for r in got)


def test_runs_of_one_word_and_copies(spark):
    rows = [(5, "a " * 120), (3, "a " * 60), (9, "a " * 49), (4, "b " + "a " * 50 + "c"), (7, "b " + "a " * 50 + "c")]
    got = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", F.expr("aggregate(spans, 0, (n, s) -> n + s.end - s.start)").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {5: 120, 3: 0, 9: 0, 4: 50, 7: 52}


def test_empty_table(spark):
    assert R.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
