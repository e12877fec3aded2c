"""The change feed of an upsert is worked out by its merge."""
from pyspark.sql import functions as F

from barrio.operators.dedupe import latest
from barrio.sources import versioned
from barrio.sources.upsert import upsert

from conftest import rows

SCHEMA = "k int, v string, x double, ver int"


def test_changes_come_from_the_merge_itself(spark, tmp, monkeypatch):
    """No second comparison of whole tables, and the feed still holds what changed."""
    def no(*a):
        raise AssertionError("the tables are compared once more")
    monkeypatch.setattr(versioned, "write_changes", no)
    drops = [[(1, "a", 1.0, 1), (2, None, None, 1), (None, "n", 0.0, 1), (4, "same", 2.0, 1)],
             [(1, "b", 1.0, 2), (3, "c", float("nan"), 2), (None, "m", 0.0, 2), (4, "same", 2.0, 1), (2, "old", None, 0)]]
    for d in drops:
        upsert(spark, spark.createDataFrame(d, SCHEMA), f"{tmp}/t", ["k"], ["ver"], changes=True)
    feed = versioned.read_changes(spark, f"{tmp}/t", 1)
    assert sorted((r.k or 0, r.v, r.ver, r._sign) for r in feed.collect()) == [
        (0, "m", 2, 1), (0, "n", 1, -1), (1, "a", 1, -1), (1, "b", 2, 1), (3, "c", 2, 1)]
    assert sorted((r.k or 0, r.v) for r in versioned.read_table(spark, f"{tmp}/t").select("k", "v").collect()
                  if r.v) == [(0, "m"), (1, "b"), (3, "c"), (4, "same")]
    assert versioned.read_changes(spark, f"{tmp}/t", 0).agg(F.sum("_sign")).first()[0] == 5


def test_changes_of_a_table_whose_keys_repeat(spark, tmp):
    spark.createDataFrame([(1, "a", 1.0, 1), (1, "b", 1.0, 1), (1, "b", 1.0, 1), (2, "z", 1.0, 1)], SCHEMA).write.parquet(f"{tmp}/t")
    upsert(spark, spark.createDataFrame([(1, "c", 1.0, 2)], SCHEMA), f"{tmp}/t", ["k"], ["ver"], changes=True)
    feed = versioned.read_changes(spark, f"{tmp}/t", 0)
    assert sorted((r.k, r.v, r._sign) for r in feed.collect()) == [(1, "a", -1), (1, "b", -2), (1, "c", 1)]


def test_the_winner_is_shuffled_once(spark):
    """Each column stands once in the aggregate, whatever orders the rows."""
    df = spark.createDataFrame([(1, "a", 1.0, 2), (1, "b", 2.0, 2), (1, "c", 3.0, None), (2, None, None, None)], SCHEMA)
    out = latest(df, ["k"], [F.col("ver") + 1])
    assert rows(out) == [(1, "b", 2.0, 2), (2, None, None, None)] and out.columns == df.columns
