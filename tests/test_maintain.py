"""Aggregates kept up from changes equal aggregates of the whole table."""
import random

import pytest
from pyspark.sql import functions as F

from barrio.operators import maintain
from barrio.operators.aggregates import avg_price, incident_totals, site_totals
from barrio.sources import versioned
from barrio.sources.upsert import upsert
from barrio.sources.versioned import read_table

ACCIDENTS = ("expedient_id int, neighborhood_name string, neighborhood_id int, year int, num_victims bigint, "
             "num_deaths bigint, num_minor_injuries bigint, num_serious_injuries bigint, ver int")


def accidents(spark, ids, ver, seed):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(i, rng.choice([" Alpha", "beta", "GAMMA ", None]), rng.choice([None, *range(6)]), rng.choice([2019, 2020, None]),
          rng.choice([None, 0, 3]), rng.choice([None, 1]), rng.choice([None, 2]), None, ver) for i in ids], ACCIDENTS)


def same(a, b, digits=8):
    def plain(df):
        return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r)
                       for r in df.select(*sorted(df.columns)).collect()), key=repr)
    assert plain(a) == plain(b)


def test_incidents_follow_new_replaced_and_moved_rows(spark, tmp):
    path, state = f"{tmp}/t", f"{tmp}/s"
    drops = [(range(0, 60), 1), (range(40, 90), 2), ([5], 3), (range(0, 90), 4), (range(88, 95), 5)]
    for n, (ids, ver) in enumerate(drops):
        upsert(spark, accidents(spark, ids, ver, seed=n), path, ["expedient_id"], ["ver"], key_buckets=3, changes=True)
        got = maintain.incident_sums(maintain.maintain(spark, path, state, maintain.INCIDENTS))
        same(got, incident_totals(read_table(spark, path)))
    assert versioned.current(spark, state).properties == {maintain.SOURCE: len(drops)}


def test_a_maximum_that_leaves_is_read_anew(spark, tmp):
    path, state = f"{tmp}/t", f"{tmp}/s"
    for ver, code in ((1, 9), (2, 2), (3, None)):
        rows = [(1, "a", code, 2019, 1, 1, 1, 1, ver)] + ([(2, "a", 5, 2019, 1, 1, 1, 1, 1)] if ver == 1 else [])
        upsert(spark, spark.createDataFrame(rows, ACCIDENTS), path, ["expedient_id"], ["ver"], changes=True)
        got = maintain.maintain(spark, path, state, maintain.INCIDENTS).first()
        assert got.neighborhood_code == {1: 9, 2: 5, 3: 5}[ver]


def test_groups_that_lose_all_rows_go(spark, tmp):
    path, state = f"{tmp}/t", f"{tmp}/s"
    schema = "k int, neighborhood_name string, year int, price_per_meter double, ver int"
    for ver, area in ((1, "a"), (2, "b")):
        upsert(spark, spark.createDataFrame([(1, area, 2019, 0.1, ver)], schema), path, ["k"], ["ver"], changes=True)
        got = maintain.maintain(spark, path, state, maintain.PRICES)
        assert [r.join_neigh for r in got.collect()] == [area]
        same(maintain.price_means(got), avg_price(read_table(spark, path)))


def test_sites_at_any_date(spark, tmp):
    path, state = f"{tmp}/t", f"{tmp}/s"
    schema = "k int, neighborhood_name string, created string, ver int"
    one = [(1, "A", "2000-02-29", 1), (2, "a ", None, 1), (3, "b", "not a date", 1), (4, None, "1999-01-01", 1)]
    for rows in (one, [(1, "b", "1960-01-01", 2), (5, "c", "2010-01-01", 2)]):
        upsert(spark, spark.createDataFrame(rows, schema), path, ["k"], ["ver"], changes=True)
        got = maintain.maintain(spark, path, state, maintain.SITES)
        for as_of in ("2002-01-01", "2024-02-29"):
            same(maintain.site_means(got, as_of), site_totals(read_table(spark, path), as_of))
            same(maintain.site_means(got, as_of, True), site_totals(read_table(spark, path), as_of, skip_missing_dates=True))


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_that_dies_is_repeated_once(spark, tmp, monkeypatch, when):
    """Whether the state's pointer was switched or not, changes count once."""
    path, state = f"{tmp}/t", f"{tmp}/s"
    upsert(spark, accidents(spark, range(20), 1, 1), path, ["expedient_id"], ["ver"], changes=True)
    maintain.maintain(spark, path, state, maintain.INCIDENTS)
    upsert(spark, accidents(spark, range(10, 30), 2, 2), path, ["expedient_id"], ["ver"], changes=True)
    plain = versioned.publish

    def dies(*args):
        if when == "after":
            plain(*args)
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(versioned, "publish", dies)
        with pytest.raises(RuntimeError, match="killed"):
            maintain.maintain(spark, path, state, maintain.INCIDENTS)
    got = maintain.maintain(spark, path, state, maintain.INCIDENTS)
    same(maintain.incident_sums(got), incident_totals(read_table(spark, path)))


def test_without_changes_the_state_is_built_anew(spark, tmp):
    path, state = f"{tmp}/t", f"{tmp}/s"
    for ver, keep in ((1, True), (2, False), (3, True)):
        upsert(spark, accidents(spark, range(ver, 20 + ver), ver, ver), path, ["expedient_id"], ["ver"], changes=keep)
        got = maintain.incident_sums(maintain.maintain(spark, path, state, maintain.INCIDENTS))
        same(got, incident_totals(read_table(spark, path)))


def test_only_changes_are_read(spark, tmp):
    """The state's plan scans the change folder and the state, not the table."""
    path, state = f"{tmp}/t", f"{tmp}/s"
    schema = "k int, neighborhood_name string, year int, price_per_meter double, ver int"
    for ver in (1, 2):
        upsert(spark, spark.createDataFrame([(ver, "a", 2019, 0.1, ver)], schema), path, ["k"], ["ver"], changes=True)
        changes = versioned.read_changes(spark, path, ver - 1)
        assert changes.select("k").collect()[0].k == ver and changes.count() == 1
        assert all("_changes" in f for f in changes.inputFiles())
        maintain.maintain(spark, path, state, maintain.PRICES)
    assert maintain.price_means(read_table(spark, state)).where(F.col("average_price_per_square_meter") == 0.1).count() == 1
