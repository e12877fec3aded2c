import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from barrio.llm import pii
from barrio.llm.tables import kept, table
from tests.llm.helpers import WORDS
from tests.llm.test_pii import luhn, plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in C.STAGES:
        out[name] = docs, (docs := kept(stage(spark, docs, SF), name))
    return out


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        assert after.columns == before.columns + ["copies"] * (name == "mix"), name
        assert 0 < after.count() <= before.count()


def test_filtering_stages_only_drop_rows(stages):
    for name in ("quality", "near_duplicates", "decontaminate"):
        before, after = stages[name]
        assert after.exceptAll(before).isEmpty(), name


def test_clean_labelled_documents_stay(spark, stages):
    before, after = stages["quality"]
    clean = before.join(table(spark, SF, "labels").where("quality = 1 AND toxic = 0"), "doc_id", "left_semi")
    assert clean.join(after, "doc_id", "left_semi").count() >= 0.97 * clean.count()


def test_one_document_of_each_text_stays(stages):
    _, after = stages["near_duplicates"]
    assert after.select("text").distinct().count() == after.count()


def test_items_are_gone(spark, stages):
    _, after = stages["decontaminate"]
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert after.where(F.exists(F.array(*map(F.lit, items)), lambda t: F.contains("text", t))).count() == 0


def test_personal_data_is_gone(stages):
    before, after = stages["pseudonyms"]
    found = r"[\w.]+@[\w.]+\.com|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}|(?:token = \"|password=)\w+"
    values = before.select(F.explode(F.regexp_extract_all("text", F.lit(found), F.lit(0))).alias("v")).distinct().collect()
    left = after.agg(F.concat_ws("\n", F.collect_list("text"))).first()[0]
    valid = [r.v for r in values if not r.v.isdigit() or luhn(r.v)]
    assert values and not [v for v in valid if v in left]
    assert any(v.isdigit() for v in valid)
    assert after.where("n_chars <> length(text)").count() == 0


def test_odd_documents(spark):
    docs = spark.createDataFrame(
        [(None, "some words here", None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
         (3, "a b c d e f", "en", None, 11), (3, "a b c d e f", "en", None, 11), (4, "g h i j k l m", "en", "s", 13)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for name, stage in C.STAGES:
            out = stage(spark, rows, SF)
            n = out.count()
            assert n <= rows.count(), name
            if name != "mix":
                assert out.columns == docs.columns and (n >= 4 or rows is not docs)


def test_run(spark, stages):
    assert sorted(r.doc_id for r in C.run(spark, SF).select("doc_id").collect()) == sorted(
        r.doc_id for r in stages["mix"][1].select("doc_id").collect())


def test_near_duplicates_equal_all_pairs(stages):
    before, after = stages["near_duplicates"]
    rows = {r.doc_id: r.text for r in before.collect()}
    sets = {}
    for doc, text in rows.items():
        words = re.findall(WORDS, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[doc] = {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    up = {doc: doc for doc in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    docs = sorted(rows)
    for i, a in enumerate(docs):
        for b in docs[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                up[max(top(a), top(b))] = min(top(a), top(b))
    assert sorted(r.doc_id for r in after.collect()) == [doc for doc in docs if top(doc) == doc]


def test_pseudonyms_equal_plain_python(stages):
    before, after = stages["pseudonyms"]
    pattern = re.compile(pii.PATTERN)
    expected = {r.doc_id: r.text and pattern.sub(lambda m: plain(pii.DEMO_KEY, m[0]), r.text) for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == expected


def test_clashing_columns(spark):
    """Every stage passes columns of any name, also of those it uses itself."""
    odd = ["copies", "mixed_id", "a.b", "Text_", "score", "chosen", "label", "grams", "known_id", "passages", "pieces",
           "kept", "component_id", "size", "target", "key", "KEPT_"]
    rows = [(i, f"some plain words of document {i % 7}, +33 1 42 68 53 00", "en", "s", 40, *["x"] * len(odd)) for i in range(20)]
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    schema = ", ".join(names + [f"`{c.replace('`', '``')}` string" for c in odd])
    docs = spark.createDataFrame(rows, schema)
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        assert out.columns[len(docs.columns):] == (["copies_"] if name == "mix" else []), name
        assert {tuple(r[5:5 + len(odd)]) for r in out.collect()} <= {("x",) * len(odd)}, name
