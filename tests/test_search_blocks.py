"""Searches over weighted blocks: as many rows to fit at any size of the input."""
import pytest
from pyspark.sql import functions as F

from barrio.operators import models
from barrio.operators.models import WEIGHT, in_blocks, tune
from barrio.plans import ml

from conftest import rows

CELLS = ("k long, neighborhood_name string, year int, accident_deaths long, number_injured_lleus long, "
         "number_injured_greu long, number_accident_victims long, number_of_accidents long, "
         "number_of_cultural_sites long, average_antiquity_cultural_sites double, average_price_per_square_meter double")


def orders(spark, n):
    """``n`` orders of 60 cells of unequal size."""
    out = []
    for i in range(n):
        c = i % 97 % 60
        out.append((i, f"a{c % 12}", 2015 + c // 12, c % 3, c % 4, c % 2, c % 5, c % 7, c % 6, float(c % 11), float(c * 37 % 60)))
    return spark.createDataFrame(out, CELLS)


def test_blocks_leave_no_row_out(spark):
    df = spark.createDataFrame([("a", None)] * 7 + [("a", 1)] * 3 + [("b", 1)] * 4 + [(None, 1)], "g string, x int")
    got = rows(in_blocks(df, ["g", "x"], 3), "g", "x", "block", WEIGHT)
    assert got == sorted([("a", None, 1, 3.0), ("a", None, 2, 3.0), ("a", None, 3, 1.0), ("a", 1, 1, 3.0), ("b", 1, 1, 3.0),
                          ("b", 1, 2, 1.0), (None, 1, 1, 1.0)], key=lambda t: tuple((v is not None, v or 0) for v in t))
    assert in_blocks(df, ["g", "x"], 1).agg(F.sum(WEIGHT), F.count("*")).first() == (15.0, 15)


def test_searches_do_not_grow_with_the_orders(spark, monkeypatch):
    """Blocks are few at any size, and give what single rows give."""
    found = {}
    for most in (10_000, 300):
        monkeypatch.setattr(models, "FIT_ROWS", most)
        p = ml.prepare(orders(spark, 6000), ["k"], groups=ml.CELL)
        n = p.train.count() + p.validation.count()
        total = sum(side.agg(F.sum(WEIGHT)).first()[0] for side in (p.train, p.validation))
        assert total == 6000 and (n == 6000 if most > 6000 else n <= most + 60)
        found[most] = [tune(f, p.train, p.validation, grid=g, weight=WEIGHT) for f, g in (
            ("decision_tree", {"maxDepth": [2, 5]}), ("logistic_regression", {"regParam": [0.01, 0.1]}))]
        p.release()
    for single, blocks in zip(*found.values(), strict=True):
        assert blocks.best_params == single.best_params
        assert blocks.metrics == pytest.approx(single.metrics)
        assert blocks.extra["cv_accuracy"] == pytest.approx(single.extra["cv_accuracy"])
