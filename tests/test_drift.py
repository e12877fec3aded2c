"""Documents and files whose fields and layouts drift."""
import json
import os

from barrio.operators.normalize import INCIDENT_TYPES
from barrio.operators.variants import flatten_variants, shape
from barrio.sources.files import read_drifting_csv
from barrio.sources.layouts import read_layouts
from pyspark.sql import functions as F

from conftest import rows

TYPED = [(1, 2019, 10.5), (1, 2020, 11.0), (2, 2019, 7.0), (3, 2018, None), (4, 2021, 3.0)]


def flat(spark, documents):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string")
    return flatten_variants(df)


def test_renamed_missing_and_retyped_fields(spark):
    docs = [{"_id": 1, "neigh_name ": "A", "district_id": 7, "info": [{"year": 2019, "PerMeter": 10.5, "Amount": 3}, {"year": 2020, "PerMeter": 11}]},
            {"id": 2, "neigh_name": "B", "history": [{"Year": "2019", "per_meter": "7.0", "amount": None}]},
            {"_id": "3", "info": [{"year": "2018", "PerMeter": "n/a"}]},
            {"_id": 4, "info": [{"year": 2021, "PerMeter": 3, "more": {"deep": [1]}}], "other": [1, "x"]},
            {"_id": 5, "info": []}, {"_id": 6, "info": None}, {"_id": 7}, {"_id": 8, "info": "none"},
            "[1, 2]", "{broken", "null", None]
    out = flat(spark, docs)
    assert rows(out, "neighborhood_id", "year", "price_per_meter") == TYPED
    assert rows(out, "_id", "neighborhood_name") == [("1-2019", "A"), ("1-2020", "A"), ("2-2019", "B"), ("3-2018", None), ("4-2021", None)]
    assert rows(out.where("neighborhood_id = 1"), "district_id", "total_amount") == [(7, None), (7, 3.0)]
    # one shape alone gives the same rows
    assert rows(flat(spark, docs[:1]), "neighborhood_id", "year", "price_per_meter") == TYPED[:2]


def test_no_documents(spark):
    assert flat(spark, []).count() == 0 and flat(spark, ["{bad"]).count() == 0
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x", "b c": [{"d": 1}]}',)], "v string").select(F.parse_json("v").alias("d"))
    assert set(shape(df, "d").fieldNames()) == {"a", "b c"}


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def landing(root):
    put(f"{root}/year_2019/a_2019.csv", 'Numero_expedient,Nom_barri,NK_Any,Numero_victimes\nE1,"Al, pha",2019,2\n\nE2,beta,,x\n')
    put(f"{root}/year_2020/b.csv", "Número d'expedient;Nom barri;Codi barri\nE3;Gràcia;4\nE4;z\n", "iso-8859-1")
    put(f"{root}/year_2020/c_2021.csv", "Numero_morts,Nom_barri\n1,alpha\n")
    put(f"{root}/d.csv", "﻿Numero_expedient;Own column;Own column\nE5;o1;o2\nE6;Numero;x;y;z\n")
    put(f"{root}/e_2022.csv", "Numero_expedient,Nom_barri\n")
    put(f"{root}/empty.csv", "")


def test_layouts_give_what_a_read_per_layout_gives(spark, tmp):
    landing(f"{tmp}/l")
    one, many = read_layouts(spark, f"{tmp}/l"), read_drifting_csv(spark, [f"{tmp}/l"])
    got = {r.expedient_id: r for r in one.data.collect()}
    assert sorted(got) == ["E1", "E2", "E3", "E4", "E5", "E6"]
    for r in many.data.select(*INCIDENT_TYPES).collect():
        if r.expedient_id in ("E1", "E2", "E3", "E4"):
            assert tuple(got[r.expedient_id])[:len(INCIDENT_TYPES)] == tuple(r)
    assert got["E1"].neighborhood_name == "Al, pha" and got["E3"].neighborhood_name == "Gràcia" and got["E2"].year is None
    assert got["E3"].year == 2020 and got["E3"].neighborhood_id == 4 and got["E1"].num_victims == 2 and got["E2"].num_victims is None
    assert sorted(got["E5"].others.values()) == ["o1", "o2"]
    report = {os.path.basename(r.file_path): (r.status, r.reason) for r in one.report.collect()}
    assert report == {"a_2019.csv": ("ok", None), "b.csv": ("ok", None), "c_2021.csv": ("quarantined", "missing expedient_id"),
                      "d.csv": ("ok", None), "e_2022.csv": ("ok", None)}


def test_the_plan_does_not_grow_with_layouts(spark, tmp):
    sizes = []
    for n in (2, 40):
        for i in range(n):
            put(f"{tmp}/{n}/f{i}.csv", f"Numero_expedient,own_{i}\nE{i},x{i}\n")
        data = read_layouts(spark, f"{tmp}/{n}", name_pattern=None).data
        assert data.count() == n
        plan = data._jdf.queryExecution().optimizedPlan().toString()
        sizes.append((len(plan.splitlines()), plan.count("Relation")))
    assert sizes[0] == sizes[1]


def test_no_files(spark, tmp):
    put(f"{tmp}/l/empty.csv", "")
    got = read_layouts(spark, f"{tmp}/l")
    assert got.data.count() == 0 and got.report.count() == 0
