import json
import os
import time

from barrio import zones
from barrio.sources.versioned import read_table

from conftest import rows
from test_nested_dedupe import PRICES


def _put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_zones_end_to_end(spark, tmp):
    land = f"{tmp}/landing"
    _put(f"{land}/prices/p1.json", "\n".join(json.dumps(r) for r in PRICES) + '\n{"_id": 5, "info": [\n')
    _put(f"{land}/incidents/year_2019/accidents_2019.csv",
         "Numero_expedient,Codi_barri,Nom_barri,NK_Any,Numero_victimes,Numero_morts\n"
         "E1,1, Alpha,2019,2,1\nE1,1, Alpha,2019,2,1\nE9,9,Omega,2019,5,0\n")
    _put(f"{land}/incidents/year_2020/accidents_2020.csv",
         "Número d'expedient;Codi barri;Nom barri;NK Any\nE2;1;alpha;2019\n", encoding="iso-8859-1")
    _put(f"{land}/incidents/year_2025/accidents_2025.csv", "foo,bar\n1,2\n")
    _put(f"{land}/sites/s.json", "\n".join(json.dumps(r) for r in [
        {"register_id": "s1", "name": "one", "created": "2000-01-01",
         "addresses": [{"neighborhood_name": "alpha "}, {"neighborhood_name": "Beta"}]},
        {"register_id": "s2", "name": "two", "created": None, "addresses": None},
    ]) + "\n")
    f = f"{tmp}/formatted"
    led = f"{tmp}/ledger"
    r1 = zones.format_price_files(spark, f"{land}/prices", f"{f}/prices", f"{led}/prices")
    assert [r["status"] for r in r1.collect()] == ["ok, 1 malformed lines"]
    i1 = zones.format_incident_files(spark, f"{land}/incidents", f"{f}/incidents", f"{led}/incidents")
    statuses = {os.path.basename(r["path"]): r["status"] for r in i1.collect()}
    assert statuses == {"accidents_2019.csv": "ok", "accidents_2020.csv": "ok", "accidents_2025.csv": "quarantined"}
    zones.format_site_files(spark, f"{land}/sites", f"{f}/sites", f"{led}/sites")
    # nothing new on a second pass
    assert zones.format_price_files(spark, f"{land}/prices", f"{f}/prices", f"{led}/prices").count() == 0
    assert zones.format_incident_files(spark, f"{land}/incidents", f"{f}/incidents", f"{led}/incidents").count() == 0
    assert rows(read_table(spark, f"{f}/prices"), "_id") == [("1-2019",), ("1-2020",), ("2-2019",)]
    assert rows(read_table(spark, f"{f}/incidents"), "expedient_id", "year") == [
        ("E1", 2019), ("E2", 2019), ("E9", 2019)]
    # a file modified in place is processed again; its newer rows win
    time.sleep(1.1)
    _put(f"{land}/incidents/year_2019/accidents_2019.csv",
         "Numero_expedient,Codi_barri,Nom_barri,NK_Any,Numero_victimes,Numero_morts\nE1,1, Alpha,2019,7,1\n")
    assert zones.format_incident_files(spark, f"{land}/incidents", f"{f}/incidents", f"{led}/incidents").count() == 1
    got = {r["expedient_id"]: r["num_victims"] for r in read_table(spark, f"{f}/incidents").collect()}
    assert got == {"E1": 7, "E2": None, "E9": 5}
    # a new price snapshot only adds years after each area's watermark
    newer = [dict(PRICES[1], info=[{"year": 2019, "PerMeter": 99.0}, {"year": 2021, "PerMeter": 21.0}])]
    _put(f"{land}/prices/p2.json", json.dumps(newer[0]) + "\n")
    zones.format_price_files(spark, f"{land}/prices", f"{f}/prices", f"{led}/prices")
    prices = {r["_id"]: r["price_per_meter"] for r in read_table(spark, f"{f}/prices").collect()}
    assert prices == {"1-2019": 10.0, "1-2020": 12.0, "2-2019": 20.0, "2-2021": 21.0}
    out = zones.build_exploitation(spark, f"{f}/prices", f"{f}/incidents", f"{f}/sites",
                                   f"{tmp}/exploitation", "2001-01-01")
    u = {(r["neighborhood_name"], r["year"]): r for r in out.collect()}
    assert set(u) == {("alpha", 2019), ("alpha", 2020), ("beta", 2019), ("beta", 2021)}
    a = u[("alpha", 2019)]
    assert (a["number_of_accidents"], a["number_accident_victims"], a["accident_deaths"], a["neighborhood_code"]) \
        == (2, 7, 1, "1")
    assert u[("alpha", 2020)]["neighborhood_code"] == "UNKNOWN"
    assert a["number_of_cultural_sites"] == 1 and u[("beta", 2019)]["number_of_cultural_sites"] == 0


def test_extend_history_files(spark, tmp):
    _put(f"{tmp}/h.json", "\n".join(json.dumps(r) for r in PRICES) + "\n")
    out = zones.extend_history_files(spark, f"{tmp}/h.json", f"{tmp}/out", end_year=2023, variance=0.0,
                                     secondary_threshold=1.0)
    years = {r["_id"]: [e["year"] for e in (r["info"] or [])] for r in out.collect()}
    assert years[1] == [2019, 2020, 2021, 2022, 2023] and years[2] == [2019, 2020, 2021, 2022, 2023]
    assert years[3] == [] and years[4] == []


def test_cli_stages(spark, tmp):
    import contextlib
    import io

    from barrio.__main__ import main
    _put(f"{tmp}/landing/prices/p.json", "\n".join(json.dumps(r) for r in PRICES) + "\n")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        main(["format-prices", "--landing", f"{tmp}/landing/prices", "--formatted", f"{tmp}/f/prices",
              "--ledger", f"{tmp}/ledger/prices"])
        main(["format-prices", "--landing", f"{tmp}/landing/prices", "--formatted", f"{tmp}/f/prices",
              "--ledger", f"{tmp}/ledger/prices"])
    first, second = [json.loads(line) for line in buf.getvalue().splitlines()]
    assert first["files"] == 1 and first["entries"][0]["rows"] == 3 and second["files"] == 0


def test_formatted_collections_carry_their_key_as_id(spark, tmp):
    land = f"{tmp}/landing"
    _put(f"{land}/incidents/year_2019/a_2019.csv", "Numero_expedient,Nom_barri\nE1,Alpha\n")
    _put(f"{land}/sites/s.json", json.dumps({"register_id": "s1", "addresses": [{"neighborhood_name": "x"}]}) + "\n")
    zones.format_incident_files(spark, f"{land}/incidents", f"{tmp}/f/i", f"{tmp}/l/i")
    zones.format_site_files(spark, f"{land}/sites", f"{tmp}/f/s", f"{tmp}/l/s")
    assert rows(read_table(spark, f"{tmp}/f/i"), "_id", "expedient_id") == [("E1", "E1")]
    assert rows(read_table(spark, f"{tmp}/f/s"), "_id", "register_id") == [("s1", "s1")]
