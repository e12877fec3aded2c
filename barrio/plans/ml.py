"""Training frames and a memoized model search over the test tables.

``order_frame``: one row per order with the area x year features of the
customer's nation in the order's year and the area's price class as the
label -- the unified model's learning problem, at a grain that grows with
the data (the area x year table itself stays at areas x years rows).

The prepared train/validation frames are checkpointed to the shared
checkpoint folder: that cuts the lineage back to lineitem/orders before
dozens of fits reuse it, and a lost executor re-reads checkpoint files
instead of re-running the joins.

Class cuts and preparation are fitted on all rows.  Orders of one cell have the
same features and label: beyond ``models.FIT_ROWS`` rows the searches get them
in weighted blocks (``models.in_blocks``), so the dozens of passes of a search
do not grow with the orders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.functions.keys import norm_key
from barrio.operators.label import DEFAULT_RELATIVE_ERROR, class_of, label_by_quantiles
from barrio.operators.models import (CATEGORY, FEATURES, LABEL, TRAIN_ORDER, WEIGHT, TuneResult, block_size,
                                     feature_prep, in_blocks, stable_split, task_count, tune, with_folds)
from barrio.operators.registry import save_model
from barrio.operators.validation import RollingResult, rolling_search
from barrio.plans import area_year as ay
from barrio.plans.tables import table
from barrio.session import scratch_path

PRICE = "average_price_per_square_meter"


def order_frame(spark: SparkSession, d: str) -> DataFrame:
    u = ay.unified(spark, d)
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", norm_key("n_name").alias("neighborhood_name"))
    keyed = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
              .select("o_orderkey", "neighborhood_name", "year"))
    return keyed.join(u, ["neighborhood_name", "year"])


@dataclass
class Prepared:
    train: DataFrame
    validation: DataFrame
    prep: PipelineModel
    cuts: list[float]
    rows: int                    # rows or blocks of both sides
    partitions: int

    def release(self) -> None:
        """Drop the cached training frames (checkpoint files stay for reruns)."""
        self.train.unpersist()
        self.validation.unpersist()


CELL = ["neighborhood_name", "year"]


def prepare(frame: DataFrame, keys: list[str], relative_error: float = DEFAULT_RELATIVE_ERROR,
            fit_on_all_rows: bool = False, groups: list[str] | None = None) -> Prepared:
    """Split by the hash of ``groups`` (of the row's ``keys``, if not given), place
    class cuts and fit preparation on train only (``fit_on_all_rows=True``
    reproduces fitting cuts, index and scaler on every row before the split, as
    the source code does).  Where features and label are the same for all rows
    of a group, only a split by group keeps what is scored out of training.

    The joined frame is checkpointed first: the sketch, the indexer and
    scaler fits and both transforms then read it instead of re-running the
    joins behind it.
    """
    frame = frame.checkpoint(eager=True)
    rows = frame.count()
    groups = groups or keys
    train_raw, val_raw = stable_split(frame, groups)
    fit_rows = frame if fit_on_all_rows else train_raw
    _, cuts = label_by_quantiles(fit_rows, PRICE, relative_error=relative_error)

    def lab(df: DataFrame) -> DataFrame:
        return df.filter(F.col(PRICE).isNotNull()).withColumn(LABEL, class_of(F.col(PRICE), cuts))

    train_l, val_l = lab(train_raw), lab(val_raw)
    prep = feature_prep().fit(lab(fit_rows))
    size = block_size(rows)
    ids = [*dict.fromkeys([*(keys if size == 1 else []), *groups])]
    spread = keys if size == 1 else [*groups, "block"]
    cols = [*dict.fromkeys([*ids, *spread]), "features", LABEL, WEIGHT]
    same = [*dict.fromkeys([*groups, CATEGORY, *FEATURES[1:], LABEL])]
    # Stored at the finest task size any family wants (AQE may have
    # coalesced a small result into one partition: every fit one task);
    # ``tuned`` coalesces, without a shuffle, for the coarser families.
    fitted = -(-rows // size)
    n = task_count(fitted, "random_forest", _cap(frame.sparkSession))

    def side(df: DataFrame) -> DataFrame:
        return prep.transform(in_blocks(df, same, size)).select(*cols)

    train = with_folds(side(train_l), groups).repartition(n, *spread).checkpoint(eager=True).cache()
    val = side(val_l).repartition(n, *spread).checkpoint(eager=True).cache()
    return Prepared(train, val, prep, cuts, fitted, n)


def _cap(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


_MEMO: dict[tuple, object] = {}


def prepared_orders(spark: SparkSession, d: str) -> Prepared:
    key = ("prepared", id(spark), d)
    if key not in _MEMO:
        _MEMO[key] = prepare(order_frame(spark, d), ["o_orderkey"], groups=CELL)
    return _MEMO[key]


def tuned(spark: SparkSession, d: str, family: str) -> tuple[TuneResult, str]:
    """The tuned model of ``family`` (fit once per session and folder) and
    the path it was saved to."""
    key = ("tuned", id(spark), d, family)
    if key not in _MEMO:
        p = prepared_orders(spark, d)
        n = task_count(p.rows, family, _cap(spark))
        train = p.train.coalesce(n) if n < p.partitions else p.train
        res = tune(family, train, p.validation, weight=WEIGHT)
        full = PipelineModel(stages=[*p.prep.stages, *res.model.stages])
        path = save_model(full, scratch_path(spark, f"model-{family}"))
        _MEMO[key] = (res, path)
    return _MEMO[key]


def prepared_sides(train: DataFrame, validation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with class cuts and preparation fitted on the first."""
    labelled, cuts = label_by_quantiles(train, PRICE)
    prep = feature_prep().fit(labelled)
    after = validation.filter(F.col(PRICE).isNotNull()).withColumn(LABEL, class_of(F.col(PRICE), cuts))
    rows = train.count()
    size = block_size(rows)
    n = task_count(-(-rows // size), "random_forest", _cap(train.sparkSession))
    same = [CATEGORY, *FEATURES[1:], LABEL]

    def side(df: DataFrame) -> DataFrame:
        return prep.transform(in_blocks(df, same, size)).select("features", LABEL, WEIGHT)

    return side(labelled).repartition(n).checkpoint(eager=True), side(after)


def rolling(spark: SparkSession, d: str, family: str) -> RollingResult:
    """Rolling-origin search over the orders, each year scored by earlier ones."""
    frame = order_frame(spark, d).checkpoint(eager=True)
    return rolling_search(family, frame, "year", prepared_sides, weight=WEIGHT)


def all_tuned(spark: SparkSession, d: str) -> list[tuple[TuneResult, str]]:
    return [tuned(spark, d, f) for f in TRAIN_ORDER]
