import os
import time

from pyspark.sql import functions as F

from barrio.sources.files import list_files, read_catalog, read_drifting_csv, sniff
from barrio.sources.ledger import (append_ledger, first_resource, pending_files, plan_resources,
                                   read_ledger)

from conftest import rows


def _put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def _landing(root):
    _put(f"{root}/year_2019/accidents_2019.csv",
         "Numero_expedient,Codi_districte,Nom_barri,NK_Any,Numero_victimes\n"
         "E1,1,Alpha,2019,2\nE1,1,Alpha,2019,3\nE2,2,Beta,2019,\n")
    _put(f"{root}/year_2020/accidents_2020.csv",
         "Número d'expedient;Codi barri;Nom barri;NK Any;Nom carrer\nE3;;Alpha;2020;x,y\n")
    _put(f"{root}/year_2021/accidents_2021.csv",
         "Número d'expedient;Codi barri;Nom barri;NK Any\nE4;7;Beta;2021\n", encoding="iso-8859-1")
    _put(f"{root}/year_2022/accidents_2022.csv", "Numero_expedient,Nom_barri\nE5,Alpha\n")
    _put(f"{root}/year_2023/part.csv", "Numero_expedient,Nom_barri\nE6,Beta\n")
    _put(f"{root}/year_2025/accidents_2025.csv", "foo,bar\n1,2\n")


def test_sniff_delimiter_and_encoding(spark, tmp):
    _landing(tmp)
    got = {os.path.basename(r["file_path"]): (r["delimiter"], r["encoding"]) for r in sniff(spark, tmp).collect()}
    assert got["accidents_2019.csv"] == (",", "UTF-8")
    assert got["accidents_2020.csv"] == (";", "UTF-8")
    assert got["accidents_2021.csv"] == (";", "ISO-8859-1")


def test_read_drifting_csv(spark, tmp):
    _landing(tmp)
    res = read_drifting_csv(spark, tmp)
    got = rows(res.data, "expedient_id", "year", "neighborhood_name", "neighborhood_id")
    assert got == [("E1", 2019, "Alpha", None), ("E1", 2019, "Alpha", None), ("E2", 2019, "Beta", None),
                   ("E3", 2020, "Alpha", None), ("E4", 2021, "Beta", 7), ("E5", 2022, "Alpha", None),
                   ("E6", 2023, "Beta", None)]
    street = [r["Nom_carrer"] for r in res.data.collect() if r["expedient_id"] == "E3"]
    assert street == ["x,y"]                                   # T6: sniffed before the parse
    rep = {os.path.basename(r["file_path"]): r["status"] for r in res.report.collect()}
    assert rep["accidents_2025.csv"] == "quarantined" and rep["accidents_2019.csv"] == "ok"


def test_ledger_pending_files(spark, tmp):
    _put(f"{tmp}/a/x.json", "{}\n")
    _put(f"{tmp}/b/x.json", "{}\n")                            # same base name, other folder
    _put(f"{tmp}/c.json", "{}\n")
    listing = list_files(spark, tmp, "*.json")
    assert listing.count() == 3
    ledger_path = f"{tmp}/_ledger"
    assert read_ledger(spark, ledger_path).count() == 0         # missing ledger = empty
    first = pending_files(listing, read_ledger(spark, ledger_path))
    assert first.count() == 3
    append_ledger(first.select("path", F.col("modificationTime").alias("mtime"),
                               F.lit(None).cast("int").alias("last_year"), F.lit(1).cast("bigint").alias("rows"),
                               F.lit("ok").alias("status"), F.current_timestamp().alias("processed_at")),
                  ledger_path)
    assert pending_files(list_files(spark, tmp, "*.json"), read_ledger(spark, ledger_path)).count() == 0
    time.sleep(1.1)
    _put(f"{tmp}/c.json", '{"a": 1}\n')                       # modified in place
    again = pending_files(list_files(spark, tmp, "*.json"), read_ledger(spark, ledger_path))
    assert [os.path.basename(r["path"]) for r in again.collect()] == ["c.json"]


CATALOG = """{"success": true, "result": {"resources": [
  {"id": "r1", "format": "csv", "url": "http://d/2019_acc.csv", "name": "Accidents"},
  {"id": "r2", "format": "CSV", "url": "http://d/acc.csv", "name": "Accidents 2021"},
  {"id": "r3", "format": "JSON", "url": "http://d/2022.json", "name": "Accidents 2022"},
  {"id": "r4", "format": "CSV", "url": "http://d/2020.csv", "name": "Accidents 2019"},
  {"id": "r5", "format": "CSV", "url": "http://d/old.csv", "name": "Accidents"}
]}}"""


def test_catalog_plan(spark, tmp):
    _put(f"{tmp}/cat.json", CATALOG)
    cat = read_catalog(spark, f"{tmp}/cat.json")
    assert cat.count() == 5
    assert rows(plan_resources(cat, limit=2), "id", "year") == [("r2", 2021), ("r4", 2020)]
    assert rows(plan_resources(cat), "id") == [("r1",), ("r2",), ("r4",)]       # year-0 r5 skipped
    landed = spark.createDataFrame([(2021,)], "year int")
    assert rows(plan_resources(cat, landed), "id") == [("r1",), ("r4",)]
    cat2 = cat.withColumn("ds", F.lit("acc")).withColumn("pos", F.monotonically_increasing_id())
    assert rows(first_resource(cat2, "ds", "pos")) == [("acc", "r1")]


RESULTS_CSV = """model,metric,value,training_time
Decision Tree,Accuracy,0.768595,72.907664
Decision Tree,Recall,0.768595,72.907664
Random Forest,Accuracy,0.690083,136.004502
Random Forest,Recall,0.690083,136.004502
Logistic Regression,Accuracy,0.623967,160.040482
"""


def test_results_csv_scan_and_report(spark, tmp):
    from barrio.operators.registry import accuracy_report, metrics_wide
    from barrio.sources.files import read_csv
    _put(f"{tmp}/results.csv", RESULTS_CSV)
    res = read_csv(spark, f"{tmp}/results.csv",
                   schema="model string, metric string, value double, training_time double")
    rep = accuracy_report(res).collect()
    assert [r["model"] for r in rep] == ["Decision Tree", "Random Forest", "Logistic Regression"]
    assert abs(rep[0]["axis_max"] - 0.968595) < 1e-9
    wide = {r["model"]: r for r in metrics_wide(res).collect()}
    assert wide["Logistic Regression"]["Recall"] is None and wide["Decision Tree"]["Recall"] == 0.768595


def test_write_partitioned_spreads_files(spark, tmp):
    from barrio.sources.sinks import write_partitioned
    df = spark.range(1000).selectExpr("id", "CAST(2000 + id % 2 AS INT) AS year")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        write_partitioned(df, f"{tmp}/p", "year", files_per_partition=4)
    finally:
        spark.conf.set(key, "true")
    files = [f for f in os.listdir(f"{tmp}/p/year=2000") if f.endswith(".parquet")]
    assert 1 < len(files) <= 4
    back = spark.read.parquet(f"{tmp}/p")
    assert back.count() == 1000 and back.schema["year"].dataType.simpleString() == "int"
