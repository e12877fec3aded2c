"""Leaderboard, champion, persisted models, reports.

The leaderboard is a long-format table (model, metric, value,
training_time, ...) with one row per model and metric -- a handful of rows
whatever the data size.  Versions count earlier registrations of the same
model name in the registry table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from barrio.operators.models import DISPLAY_NAMES, TRAIN_ORDER, TuneResult

# Metric names in the published results, their metric keys,
# and the chart-domain padding of the accuracy report.
METRICS = (("Accuracy", "accuracy"), ("Recall", "weightedRecall"),
           ("Precision", "weightedPrecision"), ("F1", "f1"))
AXIS_PADDING = 0.2

LEADERBOARD_SCHEMA = ("run_id string, model string, metric string, value double, "
                      "training_time double, train_order int, params string, path string")


def save_model(model: PipelineModel, path: str) -> str:
    """K6: persist a fitted pipeline (overwrites)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def leaderboard(spark: SparkSession, results: Sequence[TuneResult],
                paths: dict[str, str] | None = None) -> DataFrame:
    """Long-format results of the tuned models."""
    rows = []
    for i, r in enumerate(results):
        run_id = uuid.uuid4().hex
        order = TRAIN_ORDER.index(r.family) if r.family in TRAIN_ORDER else len(TRAIN_ORDER) + i
        for metric, key in METRICS:
            rows.append((run_id, DISPLAY_NAMES.get(r.family, r.family), metric, float(r.metrics[key]),
                         float(r.training_time), order, json.dumps(r.best_params, sort_keys=True),
                         (paths or {}).get(r.family)))
    return spark.createDataFrame(rows, LEADERBOARD_SCHEMA)


def register(spark: SparkSession, board: DataFrame, registry_path: str) -> DataFrame:
    """Append the board to the registry with a per-model version number."""
    try:
        prior = spark.read.parquet(registry_path).groupBy("model").agg(
            F.max("version").alias("_prev"))
    except AnalysisException:
        prior = spark.createDataFrame([], "model string, _prev int")
    out = (board.join(prior, "model", "left")
                .withColumn("version", (F.coalesce("_prev", F.lit(0)) + 1).cast("int"))
                .drop("_prev"))
    out.write.mode("append").parquet(registry_path)
    return out


def champion(board: DataFrame, metric: str = "Accuracy") -> DataFrame:
    """O2: best model by ``metric``; ties go to the earlier-trained model."""
    return (board.filter(F.col("metric") == metric)
                 .orderBy(F.desc("value"), F.asc("train_order"))
                 .limit(1))


def accuracy_report(board: DataFrame, metric: str = "Accuracy") -> DataFrame:
    """One metric, best first, with the chart domain maximum."""
    one = board.filter(F.col("metric") == metric)
    return (one.withColumn("axis_max", F.max("value").over(Window.partitionBy("metric")) + AXIS_PADDING)
               .orderBy(F.desc("value"), F.asc("model")))


def metrics_wide(board: DataFrame) -> DataFrame:
    """One row per model, one column per metric."""
    names = [m for m, _ in METRICS]
    return board.groupBy("model").pivot("metric", names).agg(F.first("value"))


def score(path: str, df: DataFrame) -> DataFrame:
    """L2: batch scoring with a persisted champion pipeline."""
    return load_model(path).transform(df)
