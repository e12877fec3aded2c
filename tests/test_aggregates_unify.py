import datetime as dt

from barrio.operators.aggregates import avg_price, incident_totals, max_per_group, site_totals
from barrio.operators.unify import UNIFIED_COLUMNS, join_coverage, unified_model

from conftest import rows

ACCIDENTS = [(" Alpha", 2019, 1, 2, 1, None, 0), ("alpha", 2019, 1, None, None, 3, None),
             ("Omega", 2019, 9, 5, 0, 1, 0)]
ACC_SCHEMA = ("neighborhood_name string, year int, neighborhood_id int, num_victims int, "
              "num_deaths int, num_minor_injuries int, num_serious_injuries int")


def test_incident_totals_fixture(spark):
    t = incident_totals(spark.createDataFrame(ACCIDENTS, ACC_SCHEMA))
    got = {r["join_neigh"]: r for r in t.collect()}
    a = got["alpha"]
    assert (a["neighborhood_code"], a["number_of_accidents"], a["number_accident_victims"],
            a["accident_deaths"], a["number_injured_lleus"], a["number_injured_greu"]) == (1, 2, 2, 1, 3, 0)


def test_incident_totals_missing_columns_are_typed_nulls(spark):
    df = spark.createDataFrame([("a", 2019)], "neighborhood_name string, year int")
    r = incident_totals(df).first()
    assert r["neighborhood_code"] is None and r["number_accident_victims"] is None
    assert r["accident_deaths"] == 0 and r["number_of_accidents"] == 1


def _inputs(spark):
    prices = spark.createDataFrame([(" Alpha ", 2019, 10.0), ("alpha", 2020, 12.0), ("Beta", 2019, 20.0),
                                    ("Beta", 2019, None)],
                                   "neighborhood_name string, year int, price_per_meter double")
    sites = spark.createDataFrame([("alpha", "2000-01-01"), ("ALPHA", None), ("Alpha", "bad")],
                                  "neighborhood_name string, created string")
    acc = spark.createDataFrame(ACCIDENTS, ACC_SCHEMA)
    return (avg_price(prices), incident_totals(acc), site_totals(sites, dt.date(2001, 1, 1)))


def test_avg_price_and_site_totals(spark):
    p, _, s = _inputs(spark)
    assert rows(p) == [("alpha", 2019, 10.0), ("alpha", 2020, 12.0), ("beta", 2019, 20.0)]
    r = s.first()
    assert r["number_of_cultural_sites"] == 3
    assert abs(r["average_antiquity_cultural_sites"] - (366 / 365) / 3) < 1e-12


def test_unified_model_fixture(spark):
    p, a, s = _inputs(spark)
    u = unified_model(p, a, s, flags=True)
    assert tuple(u.columns[:11]) == UNIFIED_COLUMNS
    got = {(r["neighborhood_name"], r["year"]): r for r in u.collect()}
    assert set(got) == {("alpha", 2019), ("alpha", 2020), ("beta", 2019)}      # omega absent
    assert got[("alpha", 2019)]["neighborhood_code"] == "1"
    assert got[("alpha", 2020)]["neighborhood_code"] == "UNKNOWN"
    assert got[("beta", 2019)]["number_of_accidents"] == 0
    assert got[("alpha", 2019)]["number_of_cultural_sites"] == got[("alpha", 2020)]["number_of_cultural_sites"] == 3
    assert got[("beta", 2019)]["has_culture_data"] is False and got[("alpha", 2020)]["has_culture_data"] is True
    assert got[("alpha", 2020)]["has_accident_data"] is False


def test_join_coverage(spark):
    p, a, s = _inputs(spark)
    got = {r["join_name"]: tuple(r)[1:] for r in join_coverage(p, a, s).collect()}
    assert got == {"accidents": (3, 1, 2, 2), "culture": (3, 2, 1, 1)}


def test_max_per_group(spark):
    df = spark.createDataFrame([("f", 2019), ("f", 2021), ("g", None)], "f string, year int")
    assert rows(max_per_group(df, ["f"], "year")) == [("f", 2021), ("g", None)]


def test_site_totals_null_skipping_variant(spark):
    sites = spark.createDataFrame([("a", "2000-01-01"), ("a", None)], "neighborhood_name string, created string")
    keep = site_totals(sites, dt.date(2001, 1, 1)).first()["average_antiquity_cultural_sites"]
    skip = site_totals(sites, dt.date(2001, 1, 1), skip_missing_dates=True).first()["average_antiquity_cultural_sites"]
    assert abs(keep - (366 / 365) / 2) < 1e-12 and abs(skip - 366 / 365) < 1e-12
