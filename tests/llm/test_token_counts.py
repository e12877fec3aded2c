import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barrio.llm import token_counts as T
from tests.llm.helpers import SCHEMA, odd_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


def brute(texts):
    processor = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    return [len(x) for x in processor.encode(texts, num_threads=1)]


def test_counts_are_the_librarys(spark):
    rng = random.Random(2)
    rows = odd_rows(7) + [
        (2000 + i, "".join(rng.choice(" \n\tabé½ﬁ　▁x\x00.,字<s>") for _ in range(rng.randint(0, 30))), "s", "x")
        for i in range(400)]
    got = T.token_counts(spark.createDataFrame(rows, SCHEMA), MODEL).collect()
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()), n)
                  for r, n in zip(rows, brute([r[1] or "" for r in rows])))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want


def test_stored_counts_are_used_and_misses_appended(spark, tmp):
    path = f"{tmp}/cache"
    docs = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, "three")], "doc_id long, text string")
    T.token_counts(docs, MODEL, path).collect()
    cache = spark.read.parquet(path)
    assert cache.count() == 2
    # a stored count is believed, one of another tokenizer is not
    fake = [(r.content, r.tokenizer, 99) for r in cache.collect()]
    other = f"{tmp}/other"
    spark.createDataFrame(fake[:1], T.CACHE).write.parquet(other)
    spark.createDataFrame([(fake[1][0], "another", 77)], T.CACHE).write.mode("append").parquet(other)
    got = {r.doc_id: r.n_tokens for r in T.token_counts(docs, MODEL, other).collect()}
    assert sorted(got.values()).count(99) in (1, 2) and 77 not in got.values()
    assert spark.read.parquet(other).where(F.col("n_tokens") < 50).count() == 1


def test_empty_table(spark):
    assert T.token_counts(spark.createDataFrame([], SCHEMA), MODEL).count() == 0
