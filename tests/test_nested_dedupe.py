import json

from pyspark.sql import functions as F

from barrio.operators.dedupe import keep_one, latest
from barrio.operators.nested import flatten_addresses, format_prices, format_sites
from barrio.sources.files import read_json_documents, read_jsonl

from conftest import rows

PRICES = [
    {"_id": 1, "district_id": 1, "district_name": "D1", "neigh_name ": " Alpha ",
     "info": [{"year": 2019, "PerMeter": 10.0, "Amount": 700.0},
              {"year": 2020, "PerMeter": 12.0, "Amount": 720.0, "diffAmount": 5.0}]},
    {"_id": 2, "district_id": 1, "district_name": "D1", "neigh_name ": "Beta",
     "info": [{"year": 2019, "PerMeter": 20.0}]},
    {"_id": 3, "district_id": 2, "district_name": "D2", "neigh_name ": "Gamma", "info": []},
    {"_id": 4, "district_id": 2, "district_name": "D2", "neigh_name ": "Delta", "info": None},
]


def _write(tmp, name, lines):
    p = f"{tmp}/{name}"
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_format_prices_fixture(spark, tmp):
    p = _write(tmp, "prices.json", [json.dumps(r) for r in PRICES])
    docs = spark.read.json(p)
    assert docs.count() == 4                                     # JSON Lines: 4 records
    assert read_json_documents(spark, p).count() == 1            # T1: multiLine sees one
    out = format_prices(docs)
    assert rows(out, "_id", "neighborhood_name", "price_per_meter", "diff_amount") == [
        ("1-2019", " Alpha ", 10.0, None), ("1-2020", " Alpha ", 12.0, 5.0), ("2-2019", "Beta", 20.0, None)]
    assert out.schema["year"].dataType.simpleString() == "int"
    assert rows(format_prices(docs, last_year=2019), "_id") == [("1-2020",)]
    # a per-document watermark column
    wm = docs.withColumn("wm", F.when(F.col("_id") == 2, 2019).otherwise(0))
    assert rows(format_prices(wm, last_year=F.col("wm")), "_id") == [("1-2019",), ("1-2020",)]


def test_read_jsonl_skips_blank_lines(spark, tmp):
    p = _write(tmp, "b.json", ['{"a": 1}', "", '{"a": 2}', ""])
    assert rows(read_jsonl(spark, p, "a int")) == [(1,), (2,)]


SITES = [
    ("s1", "one", "2000-01-01", [("alpha ",), ("Beta",)]),
    ("s2", "two", "2010-01-01", None),
    ("s3", "three", None, [("ALPHA",)]),
    ("s4", "four", "bad", [("Alpha",)]),
]


def test_format_sites_outer_explode_and_dedupe(spark):
    df = spark.createDataFrame(SITES, "register_id string, name string, created string, "
                                      "addresses array<struct<neighborhood_name string>>")
    flat = flatten_addresses(df)
    assert flat.count() == 5 and "entity_name" in flat.columns and "addresses" not in flat.columns
    out = format_sites(df)
    assert rows(out, "register_id", "neighborhood_name") == [
        ("s1", "alpha "), ("s2", None), ("s3", "ALPHA"), ("s4", "Alpha")]


def test_keep_one_is_deterministic_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, 2, "b"), (1, 2, "a"), (None, 5, "n"), (None, 4, "m")],
                               "k int, v int, s string")
    out = keep_one(df, ["k"], ["v"])
    assert rows(out) == [(None, 4, "m"), (1, 2, "a")]
    # same answer whatever the partitioning
    assert rows(keep_one(df.repartition(5), ["k"], ["v"])) == rows(out)


def test_latest_prefers_greatest_version_nulls_lose(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (1, None, "none")], "k int, ver int, s string")
    assert rows(latest(df, ["k"], ["ver"]), "s") == [("new",)]
