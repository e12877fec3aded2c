"""Late and repeated events in a stream."""
import datetime as dt

from pyspark.sql import functions as F

from barrio.streaming import events

from conftest import rows

SCHEMA = "id int, ts timestamp, v string"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def drop(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(path)


def test_late_and_repeated_events(spark, tmp):
    src = f"{tmp}/src"
    run = lambda: events.judge_files(spark, src, SCHEMA, f"{tmp}/out", ["id"], "ts", "10 minutes", f"{tmp}/ckpt")
    drop(spark, src, [(1, at(0), "a"), (2, at(5), "b"), (2, at(5), "b again"), (3, at(30), "c")])
    run()
    # the watermark is at minute 20
    drop(spark, src, [(4, at(19), "late"), (5, at(20), "on time"), (1, at(0), "late repeat"), (3, at(30), "repeat"),
                      (6, None, "no time"), (7, at(50), "d")])
    run()
    drop(spark, src, [(8, at(39), "late"), (5, at(41), "on time, key forgotten or not"), (9, at(45), "e")])
    run()
    got = rows(spark.read.parquet(f"{tmp}/out"), "id", "v", "_status")
    kept = {(i, v) for i, v, s in got if s == "kept"}
    assert {(1, "a"), (3, "c"), (5, "on time"), (7, "d"), (9, "e")} <= kept
    assert sum(i == 2 for i, _ in kept) == 1 and sum(i == 2 and s == "duplicate" for i, _, s in got) == 1
    assert {(i, v) for i, v, s in got if s == "late"} == {(4, "late"), (1, "late repeat"), (6, "no time"), (8, "late")}
    assert len(got) == 13 and (3, "repeat", "duplicate") in got


def test_state_is_bounded_by_the_delay(spark, tmp):
    src, sizes = f"{tmp}/src", []
    for hour in range(5):
        drop(spark, src, [(hour * 60 + m, at(hour * 60 + m), "x") for m in range(60)])
        sizes += events.judge_files(spark, src, SCHEMA, f"{tmp}/out", ["id"], "ts", "20 minutes", f"{tmp}/ckpt")
    assert spark.read.parquet(f"{tmp}/out").where(F.col("_status") == "kept").count() == 300
    assert max(s["keys"] for s in sizes) <= 60 + 41 and sizes[-1]["keys"] <= 60


def test_a_restart_judges_nothing_twice(spark, tmp):
    src = f"{tmp}/src"
    args = (spark, src, SCHEMA, f"{tmp}/out", ["id"], "ts", "1 hour", f"{tmp}/ckpt")
    drop(spark, src, [(1, at(0), "a")])
    events.judge_files(*args)
    events.judge_files(*args)
    drop(spark, src, [(1, at(1), "b")])
    events.judge_files(*args)
    assert rows(spark.read.parquet(f"{tmp}/out"), "v", "_status") == [("a", "kept"), ("b", "duplicate")]
