"""Token counts through a digest cache.

Stored rows: (content digest, tokenizer digest, tokens).  Documents are
reduced to the SHA-256 of their normalised content and joined with the cache;
only contents without a stored count are encoded, each distinct one once, and
their counts are appended to the cache before the result is joined from it.
The tokenizer digest covers the model file and this module's ``RULES``, so a
new model or rule never reads an old count.

Normalised content: null is the empty text; nothing else is changed, as the
model's own normaliser is the identity.  Encoding uses the sentencepiece
library.  No piece of the model has a space after another character, so
merges never cross the start of a run of spaces: within a batch each distinct
unit (spaces and the word that follows) is encoded once, and a text's count
is the sum over its units.  A model with such pieces, or with a normaliser,
has its texts encoded whole.

Every row gives a row: null and empty texts count no tokens, a null id stays
null, repeated rows are counted each.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import kept, picked
from barrio.llm.words import chunks, range_hashes
from barrio.session import scratch_path

RULES = "1: null is empty; no begin, end or added tokens"
CACHE = "content string, tokenizer string, n_tokens long"
SPACE = "▁"


def tokenizer_digest(model: bytes) -> str:
    return hashlib.sha256(model + RULES.encode()).hexdigest()


def _by_unit(processor) -> bool:
    """Whether counts of units add up to the count of the whole text."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    crossing = any(SPACE in p.lstrip(SPACE) for p in pieces)
    probe = " ½ﬁ  x　\t"
    same = "".join(processor.encode(probe, out_type=str)).startswith(SPACE * 2 + "½")
    return not crossing and same


def _unit_counts(processor, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text.  A unit is a run of spaces (one is put before each
    text, as the model does) and the bytes up to the next space."""
    n_docs = len(offsets) - 1
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    if not len(some):
        return np.zeros(n_docs, dtype=np.int64)
    # the texts, each with a space before it
    put = np.full(len(data) + len(some), 0x20, dtype=np.uint8)
    lead = offsets[some] + np.arange(len(some))
    body = np.ones(len(put), dtype=bool)
    body[lead] = False
    put[body] = data
    space = put == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[lead] = True
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(put))
    length = end - start
    h = range_hashes(put, start, end)
    _, at, which = np.unique(h, return_index=True, return_inverse=True)
    raw = put.tobytes()
    blank = np.logical_and.reduceat(space, start)[at]
    ends = end[at]
    texts = [raw[a + 1:b].decode("utf-8", "replace") for a, b in zip(start[at], ends)]
    # the model puts one space before each text itself; a unit of spaces only
    # is counted behind a letter
    texts = ["x" + " " * int(length[i]) if b else t for t, b, i in zip(texts, blank, at)]
    n = np.array([len(x) for x in processor.encode(texts, num_threads=1)], dtype=np.int64)
    n -= blank * len(processor.encode("x"))
    each = np.add.reduceat(n[which], np.searchsorted(start, lead))
    out = np.zeros(n_docs, dtype=np.int64)
    out[some] = each
    return out


def _encode(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        by_unit = _by_unit(processor)
        # larger parts have more repeated units
        for batch, data, offsets in chunks(batches, "text", 1 << 22):
            special = by_unit and pc.any(pc.match_substring(batch.column("text"), SPACE)).as_py()
            if by_unit and not special:
                n = _unit_counts(processor, data, offsets)
            else:
                n = np.array([len(x) for x in processor.encode(batch.column("text").to_pylist(), num_threads=1)],
                             dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(n, pa.int64())],
                                             names=["content", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model: bytes, cache_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row.

    ``model`` is the content of a sentencepiece model file (read it on the
    driver; it is sent to the tasks).  ``cache_path`` is a folder of Parquet
    files that later runs may share; without one the run starts a cache of its
    own in the shared scratch folder.  A run that fails between the append and
    its end leaves valid counts, and counts that two runs append twice are
    equal, so the join reads one of them.
    """
    spark = docs.sparkSession
    path = cache_path or scratch_path(spark, "token-cache")
    version = tokenizer_digest(model)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)
    texts = picked(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = texts.withColumn("content", F.sha2("text", 256))

    def stored() -> DataFrame:
        return (spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == version)
                .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))

    # the map-side step keeps one text of each digest before anything is shuffled
    distinct = keyed.groupBy("content").agg(F.first("text").alias("text"))
    (distinct.join(stored(), "content", "left_anti")
     .mapInArrow(_encode(model), "content string, n_tokens long")
     .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
     .write.mode("append").parquet(path))
    sizes = keyed.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(kept(stored(), "token-counts"), "content").select("doc_id", "n_bytes", "n_tokens")
