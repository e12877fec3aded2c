import pytest

from barrio.operators.forecast import extend_history, projected_rows, series_trends
from barrio.operators.label import label_by_quantiles, quantile_cuts

from conftest import rows

ENTRY = "array<struct<year:int, Amount:double, PerMeter:double>>"


def test_label_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "p double")
    out, cuts = label_by_quantiles(df, "p", relative_error=0.0)
    assert cuts == [2.0, 3.0]
    assert rows(out) == [(1.0, 0.0), (2.0, 1.0), (3.0, 2.0), (4.0, 2.0)]


def test_quantile_cuts_empty_input_raises(spark):
    with pytest.raises(ValueError):
        quantile_cuts(spark.createDataFrame([(None,)], "p double"), "p")


def _docs(spark, series):
    data = [(i, [(y, v, v) for y, v in s]) for i, s in enumerate(series)]
    return spark.createDataFrame(data, f"_id int, info {ENTRY}")


def test_trends_fixture(spark):
    docs = _docs(spark, [[(2019, 10.0), (2020, 12.0), (2021, 11.0)], [(2021, 7.0)], []])
    got = {r["_id"]: (r["n_years"], r["trend_Amount"]) for r in series_trends(docs).collect()}
    assert got == {0: (3, 0.5), 1: (1, 0.0), 2: (0, 0.0)}


def test_projection_without_noise(spark):
    docs = _docs(spark, [[(2019, 10.0), (2020, 12.0), (2021, 11.0)], [(2020, 5.0), (2021, 1.0)], [(2021, 3.0)]])
    out = projected_rows(docs, end_year=2023, variance=0.0, secondary_threshold=1.0)
    got = {(r["_id"], r["year"]): r["Amount"] for r in out.collect()}
    assert got[(0, 2022)] == 11.5 and got[(0, 2023)] == 12.0
    assert got[(1, 2022)] == 0.0 and got[(1, 2023)] == 0.0      # clamped, then from the clamp
    assert got[(2, 2022)] == 3.0
    assert all(v is None for v in [r["diffAmount"] for r in out.collect()])


def test_projection_end_before_last_year_adds_nothing(spark):
    docs = _docs(spark, [[(2019, 10.0), (2020, 12.0)]])
    assert projected_rows(docs, end_year=2020).count() == 0
    ext = extend_history(docs, end_year=2019)
    assert len(ext.first()["info"]) == 2


def test_noisy_projection_repeatable_and_bounded(spark):
    docs = _docs(spark, [[(2019, 100.0), (2020, 110.0)]] * 3)
    a = rows(projected_rows(docs, end_year=2030))
    b = rows(projected_rows(docs.repartition(3), end_year=2030))
    assert a == b and len(a) == 30
    assert all(r[2] >= 0.0 for r in a)
    present = [r for r in a if r[6] is not None]
    assert 0 < len(present) < len(a)                   # secondary metrics sometimes present
    ext = extend_history(docs, end_year=2030)
    assert [e["year"] for e in ext.first()["info"]] == list(range(2019, 2031))
