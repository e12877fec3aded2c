"""Late events: numbered without one window, judged by buckets of keys."""
import datetime as dt

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from barrio.operators.ranks import numbered
from barrio.streaming import events

from conftest import rows


def test_rows_are_numbered_as_by_one_window(spark):
    df = spark.createDataFrame([(None if i % 50 == 0 else i * 7919 % 1000, i % 3) for i in range(3000)], "t int, x int").repartition(7)
    got = numbered(df, ["t", "x"])
    want = df.withColumn("n", F.row_number().over(Window.orderBy("t", "x"))).withColumn("total", F.lit(3000))
    assert rows(got) == rows(want)
    assert numbered(df.limit(0), ["t"]).count() == 0


def test_events_are_judged_by_buckets_of_keys(spark, tmp):
    n, t0 = events.BUCKETS * 2, dt.datetime(2024, 1, 1)
    schema = "id int, ts timestamp"
    spark.createDataFrame([(i // 2, t0) for i in range(2 * n)] + [(None, t0), (None, t0)], schema).write.json(f"{tmp}/src")
    sizes = events.judge_files(spark, f"{tmp}/src", schema, f"{tmp}/out", ["id"], "ts", "1 hour", f"{tmp}/ckpt")
    assert 0 < max(s["keys"] for s in sizes) <= events.BUCKETS
    got = spark.read.parquet(f"{tmp}/out").groupBy("_status").count()
    assert rows(got) == [("duplicate", n + 1), ("kept", n + 1)]


class State:
    def __init__(self, value=None, mark=0):
        self.value, self.mark, self.exists, self.hasTimedOut = value, mark, value is not None, False

    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.mark

    def update(self, value):
        self.value, self.exists = value, True

    def setTimeoutTimestamp(self, ms):  # noqa: N802
        self.timeout = ms

    def remove(self):
        self.value, self.exists = None, False


def test_a_bucket_holds_the_keys_of_two_delays():
    judge, state = events._judge(100, ["x"]), State()

    def verdicts(keys, times):
        frame = pd.DataFrame({"x": 0, events.KEY: keys, events.MILLIS: times})
        return [s for f in judge((0,), iter([frame]), state) for s in f[events.STATUS]]

    assert verdicts([str(i) for i in range(1000)], range(1000)) == ["kept"] * 1000
    assert set(state.value[0]) == {str(i) for i in range(798, 1000)} and state.timeout == 1100
    state.mark = 900
    assert verdicts(["950", "899", "0", "5000", "nan"], [950, 899, 0, 900, None]) == ["duplicate", "late", "late", "kept", "late"]
