import re
from collections import Counter, defaultdict

import pytest

from barrio.llm import near_dedup as N
from tests.llm.helpers import SCHEMA, WORDS, odd_rows


def brute(rows, percent):
    sets = defaultdict(set)
    for i, t, *_ in rows:
        if i is not None:
            w = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            one = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
            sets[i] |= one
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("percent,block", [(85, 1024), (80, 2)])
def test_equals_brute_force(spark, monkeypatch, percent, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = odd_rows(3)
    got = N.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert max(Counter(r.doc_id for r in got).values()) == 1


def test_chain_without_a_common_leader(spark):
    """Neighbours in a chain are alike, its ends are not: one component."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[6 * k:6 * k + 200])) for k in range(0, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.near_duplicates(df, 85).collect()}
    assert got == {i: top for i, (_, top) in brute(rows, 85).items()} and set(got.values()) == {0}


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_corrected_for_collisions():
    import numpy as np

    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 200, 200))
    h = np.concatenate([common, a, common, b])
    packed = N._packed(N._minima(h, np.array([0, 800])))
    agree = int(N._agreeing(packed[:1], packed[1])[0])
    c = 2.0 ** -N.BITS
    assert abs((agree / N.HASHES - c) / (1 - c) - 0.6) < 0.15
