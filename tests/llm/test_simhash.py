import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barrio.llm import queries, simhash
from tests.llm.helpers import SCHEMA, WORDS, odd_rows


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORDS, lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1 if words else 0))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{(doc_id, fingerprint): smallest id reachable}"""
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    fps = sorted({fp for _, fp in rows})
    for i, x in enumerate(fps):
        for y in fps[i + 1:]:
            if (x ^ y).bit_count() <= 3:
                up[top(("fp", x))] = top(("fp", y))
    for doc, fp in rows:
        up[top(("id", doc))] = top(("fp", fp))
    least = {}
    for doc, fp in rows:
        t = top(("fp", fp))
        least[t] = min(least.get(t, doc), doc)
    return {(doc, fp): least[top(("fp", fp))] for doc, fp in rows}


def planted(seed, n):
    """Fingerprints in crowds: many share bytes, chains of near ones, zero."""
    rng = random.Random(seed)
    fps = {0, 1, 3}
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(n):
            x = base
            for _ in range(rng.randrange(0, 8)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
            fps.add(x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    base = rng.getrandbits(64)
    fps |= {base ^ rng.getrandbits(16) for _ in range(3 * n)}           # one crowded list
    return sorted(fps)


@pytest.mark.parametrize("limit", [simhash.LIST, 3])
def test_links_equal_all_pairs(spark, limit):
    rows = [(i + 10, fp) for i, fp in enumerate(planted(1, 25))]
    signed = [(doc, fp - (1 << 64) if fp >> 63 else fp) for doc, fp in rows]
    classes = spark.createDataFrame(signed, "rep long, fp long")
    links = [(r.a, r.b) for r in simhash.similar_links(classes, limit).collect()]
    of = dict(rows)
    assert all((of[a] ^ of[b]).bit_count() <= 3 for a, b in links)
    up = {doc: doc for doc, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    assert {(doc, fp): top(doc) for doc, fp in rows} == plain_components(rows)


def test_every_near_pair_shares_a_triple():
    rng = random.Random(2)
    masks = [simhash._positions(t) for t in simhash.TRIPLES]
    for _ in range(2000):
        x, flips = rng.getrandbits(64), 0
        for b in rng.sample(range(64), 3):
            flips |= 1 << b
        assert any(not flips & m for m in masks)
        got = simhash.shared_bytes(np.array([x ^ flips], np.uint64), np.uint64(x))[0]
        assert got == sum(not flips >> (8 * p) & 0xFF for p in range(8)) >= simhash.SHARED


def test_looked_up_links_equal_compared_ones():
    rng = random.Random(3)
    base = rng.getrandbits(40) << 24
    fps = np.array(sorted({base | rng.getrandbits(10) << 3 for _ in range(300)}), np.uint64)

    def groups(links):
        up = list(range(len(fps)))

        def top(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in links:
            up[max(top(a), top(b))] = min(top(a), top(b))
        return [top(i) for i in range(len(fps))]
    assert groups(simhash.looked_up_links(fps, (1 << 24) - 1)) == groups(simhash.list_links(fps))


def test_query_equals_brute_force(spark, tmp_path):
    rows = odd_rows()
    rows += [(2000, "One. two THREE", "s", "x"), (2001, "one. two\tthree", "s", "x"), (2002, "a", "s", "x"),
             (2003, "a b", "s", "x"), (1003, "another text on an id that has one", "s", "x")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    mine = [(r[0], plain_fingerprint(r[1])) for r in rows if r[0] is not None]
    roots = plain_components(mine)
    expected = sorted((doc, f"{fp:016x}", roots[doc, fp]) for doc, fp in mine)
    got = queries.op12_similar_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == expected


def test_hashes_are_sparks(spark):
    shingles = ["un café noir", "a", "three plain words", "x" * 100 + " y z"]
    got = spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()
    data = np.frombuffer("\0".join(shingles).encode(), np.uint8)
    for s, r in zip(shingles, got):
        data = np.frombuffer(s.encode(), np.uint8)
        assert simhash.fingerprints(data, np.array([0, len(data)]))[0] == r[0] % (1 << 64)


def test_long_text_is_cut_without_losing_shingles(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    data, at = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    whole = simhash.fingerprints(data, at)
    monkeypatch.setattr(simhash, "SLICE", 64)
    assert simhash.fingerprints(data, at)[0] == whole[0] == plain_fingerprint(text)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_similar_fingerprints(spark, str(tmp_path)).count() == 0
