import datetime as dt

from pyspark.sql import functions as F

from barrio.functions import antiquity_years, composite_key, norm_key, resource_year, uniform
from barrio.functions.keys import year_from_file
from barrio.functions.noise import jitter


def test_norm_key_trims_spaces_only(spark):
    df = spark.createDataFrame([(" Alpha ",), ("\tBeta",), (None,)], "a string")
    got = [r[0] for r in df.select(norm_key("a")).collect()]
    assert got == ["alpha", "\tbeta", None]


def test_composite_key_rejects_null_parts(spark):
    df = spark.createDataFrame([(1, 2015), (None, 2015)], "a int, y int")
    got = [r[0] for r in df.select(composite_key("a", "y")).collect()]
    assert got == ["1-2015", None]


def test_resource_year(spark):
    df = spark.createDataFrame([
        ("http://x/2019/acc.csv", "Accidents 2018"),   # url wins (first in text)
        ("http://x/acc.csv", "Accidents 2020"),
        ("http://x/1999.csv", "old"),
        (None, None),
    ], "url string, name string")
    assert [r[0] for r in df.select(resource_year("url", "name")).collect()] == [2019, 2020, 0, 0]


def test_year_from_file(spark):
    df = spark.createDataFrame([
        ("accidents_2022.csv", "/l/acc/year_2022/accidents_2022.csv"),
        ("part.csv", "/l/acc/year_2023/part.csv"),
        ("part.csv", "/l/acc/other/part.csv"),
    ], "n string, p string")
    assert [r[0] for r in df.select(year_from_file(F.col("n"), F.col("p"))).collect()] == [2022, 2023, None]


def test_antiquity_years_with_fixed_as_of(spark):
    df = spark.createDataFrame([("2000-01-01",), ("bad",), (None,)], "c string")
    got = [r[0] for r in df.select(antiquity_years(F.col("c"), dt.date(2001, 1, 1))).collect()]
    assert got[0] == 366 / 365 and got[1] is None and got[2] is None


def test_uniform_is_repeatable_and_in_range(spark):
    df = spark.range(1000).select(uniform(F.col("id"), seed=7).alias("u"))
    a = [r[0] for r in df.collect()]
    b = [r[0] for r in spark.range(1000).repartition(7).select(uniform(F.col("id"), seed=7)).collect()]
    assert sorted(a) == sorted(b)
    assert all(0.0 <= x < 1.0 for x in a)


def test_jitter_zero_variance_rounds_half_even(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (1.04,)], "v double")
    got = [r[0] for r in df.select(jitter(F.col("v"), 0.0, F.lit(0.9))).collect()]
    assert got == [0.2, 0.4, 1.0]
