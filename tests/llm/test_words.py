import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from barrio.llm import words as W

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0béA　", max_size=12)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 9), st.booleans())
def test_words_are_those_of_the_pattern(texts, limit, lower):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    got, found = [], {}
    for part, data, offsets in W.chunks([batch], "text", limit):
        words = W.Words(data, offsets, lower)
        flat = [data[a:b].tobytes() for a, b in zip(words.starts, words.ends)]
        for h, w in zip(words.hash.tolist(), flat):
            key = bytes(c + 32 if lower and 65 <= c <= 90 else c for c in w)
            assert found.setdefault(key, h) == h
        got += [[w.decode() for w in flat[a:b]] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(set(found.values())) == len(found)


def test_gram_hashes_depend_on_their_values_only():
    v = W.mix(np.arange(1, 40, dtype=np.uint64))
    for k in range(1, 20):
        g = W.grams(np.concatenate([v, v]), k)
        assert len(g) == 78 - k + 1 and g[0] == g[39] and len(set(g[:39].tolist())) == 39


def test_prefix_hash_of_equal_ranges():
    v = np.array([5, 6, 7, 5, 6, 7, 5], dtype=np.uint64)
    h = W.PrefixHash(v).of(np.array([0, 3, 1, 0]), np.array([3, 6, 4, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3
