import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barrio.llm import oracles_conversations, prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def rows_of(seed=1):
    """Short and long conversations that share beginnings, hot turns, odd rows."""
    rng = random.Random(seed)
    turns = [("user", f"t{i}" * rng.randrange(1, 4)) for i in range(3)]
    rows = []
    for c in [*range(0, 60), *range(100, 130), 205, 1000, -7, -100]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 17])):
            rows.append((c, t, *rng.choice(turns[:2] if t < 6 else turns), "x"))
    # long ones: equal for long, then apart; one that ends at a power of two
    for c, n, own in ((301, 64, 99), (302, 70, 64), (303, 70, 64), (305, 33, 20), (304, 16, 99), (306, 97, 96)):
        rows += [(c, t, "user", f"long {t}" if t < own else f"own {c} {t}", "x") for t in range(n)]
    rows += [(400, None, None, None, "x"), (400, None, "user", None, "x"), (400, 3, None, "é", "x"), (401, 0, "", "", "x"),
             (None, 1, "user", "hi", "x"), (402, 1, "user", "word " * 50000, "x"), (403, 1, "user", "word " * 50000, "x")]
    return rows + rows[:7]


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, depth VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?)", rows)
    got = con.execute(oracles_conversations.OP11)
    return [d[0] for d in got.description], sorted(got.fetchall(), key=repr)


@pytest.mark.parametrize("stretch", [4, 1024])
def test_query_equals_sql_on_odd_rows(spark, tmp_path, monkeypatch, stretch):
    rows = rows_of()
    names, expected = by_sql(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    plain = prefix_trie.trie
    monkeypatch.setattr(prefix_trie, "trie", lambda *a: plain(*a, stretch=stretch))
    got = queries.op11_prefix_trie(spark, str(tmp_path))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == expected


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "hi", "x")]])
def test_no_conversations(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op11_prefix_trie(spark, str(tmp_path)).count() == 0


def test_turnless_conversations_end_in_the_root(spark):
    """Conversations that are rebuilt to nothing are members of the root only."""
    members = spark.range(5).select(F.col("id").alias("conv_id"))
    turns = spark.createDataFrame([], "conv_id long, pos long, a long, b long, chars long")
    nodes, ends = prefix_trie.trie(turns, members)
    assert [tuple(r) for r in nodes.drop("a", "b").collect()] == [(0, 0, None, 5, 0, 1, 0)]
    digests = prefix_trie.end_digests(ends).collect()
    assert [r.sha256 for r in digests] == [hashlib.sha256(b"0,1,2,3,4").hexdigest()]


def test_prefix_names_do_not_depend_on_what_follows():
    rng = np.random.default_rng(2)
    turns = rng.integers(0, 1 << 63, (50, 2)).astype(np.uint64)
    names, above = prefix_trie.prefix_names(turns, np.array([0]), np.array([50]), np.array([[1, 2]], np.uint64))
    assert len({tuple(n) for n in names}) == 50 and (above[1:] == names[:-1]).all()
    for n in (1, 2, 7, 8, 31, 32):
        first, size = np.array([0, n]), np.array([n, n])
        twice, _ = prefix_trie.prefix_names(np.concatenate([turns[:n]] * 2), first, size,
                                            np.array([[1, 2], [5, 6]], np.uint64))
        assert (twice[:n] == names[:n]).all() and not (twice[n:] == names[:n]).any()


def test_many_ends_are_digested_in_order(spark):
    """One node that most conversations end in, over several partitions."""
    ends = spark.range(0, 30000, 1, 6).select((29999 - F.col("id")).alias("conv_id"), F.lit(1).cast("long").alias("a"),
                                              F.when(F.col("id") % 10 > 0, 2).otherwise(3).cast("long").alias("b"))
    got = {r.b: r.sha256 for r in prefix_trie.end_digests(ends).collect()}
    ids = {2: [i for i in range(30000) if (29999 - i) % 10], 3: [i for i in range(30000) if not (29999 - i) % 10]}
    assert got == {b: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for b, x in ids.items()}
