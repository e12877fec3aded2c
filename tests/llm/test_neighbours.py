import math
import random

import pytest
from pyspark.sql import functions as F

from barrio.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k):
    first = {}
    for i, v in sorted((i, v) for i, v, *_ in rows if i is not None and v and all(
            x is not None and math.isfinite(x) for x in v) and any(v)):
        first.setdefault(i, v)

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))

    return {i: sorted((-cosine(a, b), j) for j, b in first.items() if j != i and len(b) == len(a))[:k]
            for i, a in first.items() if i % 5 == 0}


@pytest.mark.parametrize("block,part", [(1 << 20, 4096), (64, 3)])
def test_equals_brute_force(spark, monkeypatch, block, part):
    monkeypatch.setattr(N, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(N, "QUERY_BLOCK", block // 8)
    monkeypatch.setattr(N, "PART", part)
    rng = random.Random(4)
    # halves are exact floats: equal directions have equal scores
    vector = lambda n: [rng.randrange(-6, 7) / 2 for _ in range(n)]
    rows = [(i, vector(4), 1, "s") for i in range(60)]
    rows += [(100 + i, rows[5][1], 1, "s") for i in range(30)] + [rows[10], (11, [9.0, 1.0, 0.5, 2.0], 1, "s")]
    rows += [(200, None, 1, None), (205, [], 1, "s"), (210, [0.0] * 4, 1, "s"), (215, [1.0, None, 0.0, 1.0], 1, "s"),
             (220, [float("nan"), 1.0, 1.0, 1.0], 1, "s"), (None, [1.0] * 4, 1, "s"), (225, [1.0, 2.0], 1, "s"),
             (226, [2.0, 1.0], None, "s"), (230, [3e38, -3e38, 1.0, 0.0], 1, "s"), (235, [1e-40, 0.0, 0.0, 0.0], 1, "s")]
    got = {}
    for r in N.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0, 5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    # single precision input is what is searched
    seen = [(r.vec_id, r.embedding) for r in spark.createDataFrame(rows, SCHEMA).collect()]
    want = {q: best for q, best in brute(seen, 5).items() if best}
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, len(best) + 1))
        assert [s for _, _, s in got[q]] == pytest.approx([-s for s, _ in best], abs=1e-12)
        for (s, j), (_, v, _) in zip(best, got[q]):
            # the same vector, or one that is as near within rounding
            assert j == v or any(abs(s - t) < 1e-12 and v == u for t, u in brute(seen, 99)[q])


def test_equal_vectors_go_by_id(spark):
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(40)]
    got = N.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 20, 5)
    assert [(r.rank, r.vec_id) for r in got.orderBy("rank").collect()] == [(i + 1, i) for i in range(5)]


def test_error_bound_holds():
    import numpy as np

    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(20, 64)), rng.normal(size=(300, 64))
    q8, qs, ql, qe = N._rounded(q)
    x8, xs, _, xe = N._rounded(x)
    near = N._products(q8, x8) * qs[:, None] * xs
    for i in range(20):
        assert (abs(near[i] - N.cosine(q[i], x)) <= ql[i] * xe + qe[i]).all()


def test_empty_table(spark):
    assert N.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0).count() == 0
