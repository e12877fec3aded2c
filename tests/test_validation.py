"""Splits that do not leak, rolling origins, baselines, and the queries on them."""
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barrio.operators.validation import (origin_times, rolling_search, shared_groups, with_group_folds, with_origins)
from barrio.plans.baselines import with_baselines

SCHEMA = "k long, area string, year int, x double, price_category double"


def frame(spark, years=range(2010, 2016)):
    """The class follows x in even years and its mirror in odd ones."""
    return spark.createDataFrame([(i, f"a{i % 9}", y, float(i % 3), float(i % 3 if y % 2 == 0 else 2 - i % 3))
                                  for y in years for i in range(90)], SCHEMA)


def test_no_group_stands_on_both_sides(spark):
    rows = with_group_folds(frame(spark), ["area", "year"])
    assert shared_groups(rows, ["area", "year"]).isEmpty()
    assert shared_groups(rows.where("split = 'train'"), ["area", "year"], "fold").isEmpty()
    assert rows.where("split = 'validation' AND fold IS NOT NULL").isEmpty()
    by_row = with_group_folds(frame(spark), ["k"])                       # a split by row leaks
    assert not shared_groups(by_row, ["area", "year"]).isEmpty()
    again = with_group_folds(frame(spark).repartition(7), ["area", "year"])
    assert again.exceptAll(rows).isEmpty()


def test_origins_train_on_earlier_years_only(spark):
    df = frame(spark).unionByName(spark.createDataFrame([(1, "a", None, 0.0, 0.0)], SCHEMA))
    times = origin_times(df, "year", 3)
    assert times == [2013, 2014, 2015]
    rows = with_origins(df, "year", times)
    assert rows.where("side = 'train' AND year >= origin").isEmpty()
    assert rows.where("side = 'validation' AND year <> origin").isEmpty()
    assert {(r.origin, r.side): r.n for r in rows.groupBy("origin", "side").agg(F.count("*").alias("n")).collect()} == {
        (y, s): 90 * (y - 2010 if s == "train" else 1) for y in times for s in ("train", "validation")}
    assert origin_times(df, "year", 99) == [2011, 2012, 2013, 2014, 2015]
    assert origin_times(df.where("year = 2010"), "year", 3) == [] == origin_times(df.limit(0), "year", 3)


def test_rolling_search_sees_no_later_year(spark):
    """Every year turns the classes round: who saw the year itself would be right."""
    def prepare(train, validation):
        v = VectorAssembler(inputCols=["x"], outputCol="features")
        return v.transform(train), v.transform(validation)
    res = rolling_search("decision_tree", frame(spark, range(2010, 2013)), "year", prepare, origins=2,
                         grid={"maxDepth": [1, 3]})
    assert [o.time for o in res.origins] == [2011, 2012] and set(res.best_params) == {"maxDepth"}
    # 2011 is foretold from 2010 alone: the mirrored classes are hit only in the middle
    assert res.origins[0].metrics["accuracy"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="earlier ones"):
        rolling_search("decision_tree", frame(spark, [2010]), "year", prepare, grid={"maxDepth": [1]})


def test_baselines_look_back_only(spark):
    rows = [("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 2.0), ("a", 6, 1.0), ("b", 1, 1.0), ("b", 2, 2.0)]
    cells = spark.createDataFrame(rows, "neighborhood_name string, year int, price_category double")
    got = {r.year: (r.last_year, r.two_years_ago, r.usual) for r in with_baselines(cells).collect()}
    assert got == {3: (0.0, 2.0, 0.0), 4: (0.0, 0.0, 0.0), 6: (2.0, 0.0, 0.0)}
