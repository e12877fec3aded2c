"""A stream over files that are rewritten in place."""
import json
import os
import time

import pytest

from barrio.sources import versioned
from barrio.sources.versioned import read_table
from barrio.streaming import rewritten

from conftest import rows

SCHEMA = "k int, v string"


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".tmp", "w") as f:
        f.write("".join(json.dumps(dict(zip(("k", "v"), r))) + "\n" for r in data))
    os.replace(path + ".tmp", path)
    time.sleep(0.01)


def test_a_rewritten_file_is_upserted_once_more(spark, tmp):
    args = (spark, f"{tmp}/src", SCHEMA, f"{tmp}/table", ["k"], f"{tmp}/ckpt")
    put(f"{tmp}/src/a/one.json", [(1, "a"), (2, "a")])
    put(f"{tmp}/src/two.json", [(3, "a")])
    put(f"{tmp}/src/_hidden.json", [(9, "no")])
    assert rewritten.stream_changed_files(*args) == 2
    assert rows(read_table(spark, f"{tmp}/table"), "k", "v") == [(1, "a"), (2, "a"), (3, "a")]
    assert rewritten.stream_changed_files(*args) == 0                     # a restart finds nothing
    put(f"{tmp}/src/a/one.json", [(1, "b"), (4, "b")])                     # rewritten in place
    put(f"{tmp}/src/three.json", [(3, "c")])
    before = versioned.current(spark, f"{tmp}/table").number
    assert rewritten.stream_changed_files(*args) == 2
    assert rows(read_table(spark, f"{tmp}/table"), "k", "v") == [(1, "b"), (2, "a"), (3, "c"), (4, "b")]
    assert versioned.current(spark, f"{tmp}/table").number == before + 1    # one upsert
    assert rewritten.stream_changed_files(*args) == 0


def test_a_batch_that_fails_is_replayed(spark, tmp, monkeypatch):
    args = (spark, f"{tmp}/src", SCHEMA, f"{tmp}/table", ["k"], f"{tmp}/ckpt")
    put(f"{tmp}/src/one.json", [(1, "a")])
    with monkeypatch.context() as m:
        m.setattr(rewritten, "upsert", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(Exception, match="killed"):
            rewritten.stream_changed_files(*args)
    put(f"{tmp}/src/two.json", [(2, "a")])
    assert rewritten.stream_changed_files(*args) == 2
    assert rows(read_table(spark, f"{tmp}/table"), "k", "v") == [(1, "a"), (2, "a")]


def test_offsets_do_not_grow(tmp):
    for i in range(20):
        put(f"{tmp}/src/{i}.json", [(i, "a")])
        os.utime(f"{tmp}/src/{i}.json", (1000 + i // 10, 1000 + i // 10))
    reader = rewritten.FileVersionsReader(f"{tmp}/src", "*.json")
    end = reader.latestOffset()
    assert len(json.loads(end["paths"])) == 10
    assert len(reader.partitions(reader.initialOffset(), end)[0].files) == 20
    assert reader.partitions(end, end) == []
    put(f"{tmp}/src/x.json", [])
    os.utime(f"{tmp}/src/x.json", (1001, 1001))                            # as new as the newest
    assert [os.path.basename(p) for p, _ in reader.partitions(end, reader.latestOffset())[0].files] == ["x.json"]
