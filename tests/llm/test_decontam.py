import random

import pyarrow as pa

from barrio.llm import decontam as D
from barrio.llm.words import text_buffer
from tests.llm.helpers import SCHEMA, odd_rows


def fewest_edits(a, b):
    """Of a against any part of b."""
    before = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return min(before)


def edited(rng, text, n):
    t = list(text)
    for _ in range(n):
        p = rng.randrange(len(t))
        kind = rng.randrange(3)
        if kind == 0:
            t[p] = rng.choice("xyz")
        elif kind == 1:
            del t[p]
        else:
            t.insert(p, rng.choice("xyz"))
    return "".join(t)


def test_finds_what_full_alignment_finds():
    rng = random.Random(5)
    letters = "abcdefgh "
    prose = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = D.Items(list(range(8)), [prose(rng.randint(60, 140)) for _ in range(8)])
    docs = []
    for _ in range(120):
        t = prose(rng.randint(0, 150))
        at = rng.randint(0, len(t))
        item = items.texts[rng.randrange(8)].tobytes().decode()
        docs.append(t[:at] + " " + edited(rng, item, rng.randint(0, 12)) + " " + t[at:])
    text, offsets, _ = D.folded(*text_buffer(pa.array(docs)))
    got = {}
    for doc, item, _, _, edits in items.verified(text, offsets):
        got[doc, item] = min(edits, got.get((doc, item), 99))
    for i in range(len(docs)):
        folded = text[offsets[i]:offsets[i + 1]].tobytes()
        for j in range(8):
            e = fewest_edits(items.texts[j].tobytes(), folded)
            assert got.get((i, j)) == (e if e <= items.k[j] else None)
    assert sum(e > 0 for e in got.values()) > 20


def test_rows_columns_and_spans(spark):
    item = "The quick brown fox jumps over the lazy dog, and then it sleeps all day long."
    docs = spark.createDataFrame(
        [(1, "Before. THE QUICK -- brown fox jumps over the lazy dog and then it sleeps all day long! After", "a", "k"),
         (1, "clean text about a quick brown fox", "b", "k"), (None, item, "c", None), (2, None, "d", "k"),
         (3, "", None, "k"), (4, item + " " + item, "e", "k"), (5, "no q4 here", "f", "k"), (6, "it is Q4!", "f", "k")],
        "doc_id long, text string, passages string, item_id string")
    bench = spark.createDataFrame([(7, item), (8, item), (9, "q4"), (10, ""), (11, None)], "item_id long, text string")
    out = D.benchmark_passages(docs, bench)
    assert out.columns == docs.columns + ["passages_"]
    got = {(r.doc_id, r.passages): [(p.item_id, r.text.encode()[p.start:p.end].decode(), p.edits) for p in r.passages_]
           for r in out.collect()}
    first = "THE QUICK -- brown fox jumps over the lazy dog and then it sleeps all day long"
    assert got[1, "a"] == [(7, first, 0), (8, first, 0)]
    assert got[1, "b"] == got[2, "d"] == got[3, None] == []
    assert [x[0] for x in got[None, "c"]] == [7, 8] and [x[0] for x in got[4, "e"]] == [7, 7, 8, 8]
    assert got[5, "f"] == [(9, "q4", 0)] and got[6, "f"] == [(9, "Q4", 0)]
    kept = D.decontaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3} and kept.count() == 3


def test_rounds_of_items(spark, monkeypatch):
    item = "word after word the passage goes on until it ends here at last"
    docs = spark.createDataFrame([(1, f"x {item} y {item[::-1]}")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, item[::-1]), (3, "something else entirely, not in there")],
                                  "item_id long, text string")
    monkeypatch.setattr(D, "ROUND_BYTES", 10)
    assert [p.item_id for p in D.benchmark_passages(docs, bench).first().passages] == [1, 2]


def test_odd_and_empty_tables(spark):
    docs, bench = spark.createDataFrame(odd_rows(), SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminated(docs, bench).count() == len(odd_rows())
    assert D.decontaminated(docs.limit(0), spark.createDataFrame([(1, "abc")], "item_id long, text string")).count() == 0


def test_batches_with_and_without_passages(spark):
    item = "word after word the passage goes on until it ends here at last"
    docs = spark.createDataFrame([(i, item if i % 3 == 1 else "clean") for i in range(9)], "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        out = D.benchmark_passages(docs.coalesce(1), spark.createDataFrame([(1, item)], "item_id long, text string"))
        assert {r.doc_id for r in out.collect() if r.passages} == {1, 4, 7}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repetitive_items_and_texts_take_linear_memory():
    """No product of an item's places and a text's."""
    import resource
    import time

    items = D.Items([1, 2, 3], ["a " * 500, "na " * 300 + "batman", "x" * 800])
    start = time.process_time()
    for unit, item in (("a ", 0), ("na ", None), ("x", 2)):
        text, offsets, _ = D.folded(*text_buffer(pa.array([unit * (100_000 // len(unit))])))
        found = items.verified(text, offsets)
        assert {r[1] for r in found} >= ({item} if item is not None else set())
        assert len({(r[1], r[2], r[3]) for r in found}) == len(found)
    assert time.process_time() - start < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 4 << 20        # KB


def test_a_replaced_word_does_not_hide_a_short_item():
    item = "Which of these rivers flows through the largest number of different countries today?"
    items = D.Items([1], [item])
    text, offsets, _ = D.folded(*text_buffer(pa.array(["Quiz: " + item.replace("largest", "greatest") + " Answer", "Quiz: rivers"])))
    assert [(d, e) for d, _, _, _, e in items.verified(text, offsets)] == [(0, 5)]


def test_counts_of_repeated_grams_miss_nothing():
    """Items and texts over two letters, where every q-gram repeats."""
    rng = random.Random(9)
    short = lambda n: "".join(rng.choice("ab") for _ in range(n))
    items = D.Items(list(range(5)), [short(10) * 7, "ab" * 40, "aab" * 30, short(90), "a" * 70])
    docs = []
    for _ in range(60):
        item = items.texts[rng.randrange(5)].tobytes().decode()
        docs.append(short(rng.randint(0, 60)) + edited(rng, item, rng.randint(0, 10)) + short(rng.randint(0, 60)))
    text, offsets, _ = D.folded(*text_buffer(pa.array(docs)))
    got = {(r[0], r[1]) for r in items.verified(text, offsets)}
    for i in range(len(docs)):
        folded = text[offsets[i]:offsets[i + 1]].tobytes()
        for j in range(5):
            assert ((i, j) in got) == (fewest_edits(items.texts[j].tobytes(), folded) <= items.k[j]), (i, j)


def test_rounds_one_after_another(spark, monkeypatch):
    docs = spark.createDataFrame(odd_rows() + [(5000, "the first item of them all, and then the second item of the list", "s", "x")], SCHEMA)
    items = spark.createDataFrame([(1, "the first item of them all"), (2, "the second item of the list"), (3, None), (4, "not there at all")],
                                  "item_id long, text string")
    whole = sorted(map(str, D.benchmark_passages(docs, items).collect()))
    monkeypatch.setattr(D, "ROUND_BYTES", 20)
    assert sorted(map(str, D.benchmark_passages(docs, items).collect())) == whole
    assert sum("item_id=2" in r and "item_id=1" in r for r in whole) == 1
