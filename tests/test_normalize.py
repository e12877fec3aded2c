from pyspark.sql import functions as F

from barrio.operators.normalize import (INCIDENT_TYPES, conform, header_plan, normalize_headers,
                                        rename_first_present, union_flexible, with_year)


def test_header_plan_first_key_wins_and_second_target_dropped():
    plan, dropped = header_plan(["Any", "NK Any", "Numero_expedient", "Carrer d'en X", "a.b"])
    assert plan == [("Any", "year"), ("Numero_expedient", "expedient_id"),
                    ("Carrer d'en X", "Carrer_den_X"), ("a.b", "a.b")]
    assert dropped == ["NK Any"]


def test_header_plan_accented_and_folded():
    plan, _ = header_plan(["Número d'expedient", "Codi barri", "Nom barri", " NK Any "])
    assert [t for _, t in plan] == ["expedient_id", "neighborhood_id", "neighborhood_name", "year"]
    # a header whose accents were lost still maps after folding
    plan, _ = header_plan(["Nmero d'expedient", "Nom districte"])
    assert [t for _, t in plan] == ["expedient_id", "district_name"]


def test_header_plan_sanitized_name_never_clashes_with_target():
    plan, _ = header_plan(["year", "NK_Any"])
    assert dict(plan) == {"year": "year_2", "NK_Any": "year"}


def test_normalize_headers_dotted_columns(spark):
    df = spark.createDataFrame([(1, "x", "y")], "`Numero_expedient` int, `a.b` string, `Nom barri` string")
    out = normalize_headers(df)
    assert out.columns == ["expedient_id", "a.b", "neighborhood_name"]
    assert out.first()["a.b"] == "x"


def test_rename_prefers_spaced_spelling(spark):
    df = spark.createDataFrame([("a", "b")], "`neigh_name ` string, neigh_name string")
    out = rename_first_present(df, ("neigh_name ", "neigh_name"), "neighborhood_name")
    assert out.first()["neighborhood_name"] == "a"


def test_with_year_keeps_column_else_uses_file(spark):
    df = spark.createDataFrame([("2019", "f.csv", "/x/year_2020/f.csv")], "year string, n string, p string")
    assert with_year(df, F.col("n"), F.col("p")).first()["year"] == 2019
    df2 = df.drop("year")
    assert with_year(df2, F.col("n"), F.col("p")).first()["year"] == 2020
    assert with_year(df2, F.col("n"), F.col("p"), name_pattern=None,
                     folder_pattern=r"nothing_(\d{4})").first()["year"] is None


def test_conform_typed_nulls_and_try_cast(spark):
    df = spark.createDataFrame([("7", "", "x")], "expedient_id string, neighborhood_id string, extra string")
    out = conform(df, INCIDENT_TYPES)
    r = out.first()
    assert r["expedient_id"] == "7" and r["neighborhood_id"] is None and r["num_deaths"] is None
    assert out.schema["num_deaths"].dataType.simpleString() == "bigint"
    assert out.columns[-1] == "extra"


def test_union_flexible(spark):
    a = spark.createDataFrame([(1, "1.5")], "k int, v string")
    b = spark.createDataFrame([(2, 2.5, "z")], "k int, v double, w string")
    out = union_flexible([a, b], {"v": "double"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.5, None), (2, 2.5, "z")]
