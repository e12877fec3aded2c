"""Edge cases that pin down the source semantics (and where we differ)."""

import os

import pytest
from pyspark.sql import functions as F

from barrio.functions.keys import year_from_file
from barrio.operators.label import quantile_cuts
from barrio.operators.normalize import header_plan
from barrio.sources.files import read_drifting_csv, sniff


def _put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_sniff_tie_goes_to_comma(spark, tmp):
    _put(f"{tmp}/t.csv", "a;b,c\n1;2,3\n")                 # one of each on the first line
    _put(f"{tmp}/s.csv", "a;b;c,d\n1;2;3,4\n")
    got = {os.path.basename(r["file_path"]): r["delimiter"] for r in sniff(spark, tmp).collect()}
    assert got == {"t.csv": ",", "s.csv": ";"}


def test_header_substring_match_is_literal():
    # any header containing "Any" maps to year, as in the source
    plan, _ = header_plan(["Any de referencia", "Numero_expedient"])
    assert dict(plan)["Any de referencia"] == "year"
    plan, _ = header_plan(["Company"])                      # "any" != "Any"
    assert dict(plan)["Company"] == "Company"
    # matching is case-sensitive
    plan, _ = header_plan(["numero_expedient"])
    assert dict(plan)["numero_expedient"] == "numero_expedient"


def test_year_from_writer_named_files(spark):
    df = spark.createDataFrame([("part-00000-1a2b.c000.csv", "/x/year=2021/part-00000-1a2b.c000.csv")],
                               "n string, p string")
    # the source rule reads the first four digits of the name: here "0000"
    assert df.select(year_from_file(F.col("n"), F.col("p"))).first()[0] == 0
    # the caller can switch the name rule off and use Hive-style folders
    from barrio.operators.normalize import with_year
    out = with_year(df, F.col("n"), F.col("p"), name_pattern=None, folder_pattern=r"year=(\d{4})")
    assert out.first()["year"] == 2021


def test_drifting_csv_reports_dropped_duplicate_headers(spark, tmp):
    _put(f"{tmp}/year_2024/accidents_2024.csv", "Any,NK Any,Numero_expedient,a.b\n2024,2023,E1,x\n")
    res = read_drifting_csv(spark, tmp)
    r = res.data.first()
    assert (r["year"], r["expedient_id"], r["a.b"]) == (2024, "E1", "x")
    assert res.report.first()["dropped_headers"] == "NK Any"


def test_quantile_cuts_within_sketch_error(spark):
    df = spark.range(100_000).select((F.col("id") * 7 % 100_000).cast("double").alias("p"))
    lo, hi = quantile_cuts(df, "p")                          # default relative error 0.01
    assert abs(lo - 33_000) <= 1_000 and abs(hi - 67_000) <= 1_000


@pytest.mark.parametrize("parts", [1, 7])
def test_projection_independent_of_partitioning(spark, parts):
    from barrio.operators.forecast import projected_rows
    docs = spark.range(50).select(F.col("id").alias("_id"), F.array(
        F.struct(F.lit(2019).alias("year"), (F.col("id") * 10.0).alias("Amount")),
        F.struct(F.lit(2020).alias("year"), (F.col("id") * 12.0).alias("Amount"))).alias("info"))
    a = sorted(tuple(r) for r in projected_rows(docs, end_year=2024).collect())
    b = sorted(tuple(r) for r in projected_rows(docs.repartition(parts), end_year=2024).collect())
    assert a == b


def test_latest_keeps_dotted_and_spaced_column_names(spark):
    from barrio.operators.dedupe import latest
    df = spark.createDataFrame([(1, 1, "x", "p"), (1, 2, "y", "q")], "k int, ver int, `a.b` string, `c d` string")
    out = latest(df, ["k"], ["ver"])
    assert out.columns == ["k", "ver", "a.b", "c d"]
    assert tuple(out.first()) == (1, 2, "y", "q")
