import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["neighborhood_name", "year"]
    assert len(df.columns) == 11
    n = df.count()
    assert n > 0
    assert E.entry(spark).schema == df.schema


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_flagship_rows_equal_price_groups(spark):
    from barrio.plans import area_year as ay
    assert ay.unified(spark, SMALL).count() == ay.price_groups(spark, SMALL).count()
