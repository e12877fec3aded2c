"""Feature preparation, stable split/folds and tuned classifiers.

All fitting is Spark ML: the data stays distributed and only models and
metrics come back.  Splits and folds hash the row key, so they do not
depend on partitioning or on which executor recomputed a partition.
Preparation (index, assemble, scale) is fit on the training rows only.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barrio.functions.noise import hash32

# Features, label, split, folds and grids of the source model search.
FEATURES = ("neighborhood_index", "year", "accident_deaths", "number_injured_lleus",
            "number_injured_greu", "number_accident_victims", "number_of_accidents",
            "number_of_cultural_sites", "average_antiquity_cultural_sites")
CATEGORY = "neighborhood_name"
LABEL = "price_category"
TRAIN_FRACTION = 0.7
SEED = 42
FOLDS = 3
LOGISTIC_MAX_ITER = 50
GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]},
    "random_forest": {"numTrees": [20, 50, 100], "maxDepth": [5, 10]},
    "decision_tree": {"maxDepth": [5, 10, 15, 20]},
}
TRAIN_ORDER = ("logistic_regression", "random_forest", "decision_tree")
DISPLAY_NAMES = {"logistic_regression": "Logistic Regression", "random_forest": "Random Forest",
                 "decision_tree": "Decision Tree"}

# Training rows per task, by family (measured on local[8], 105k rows):
# iterative fits with cheap passes (logistic regression: one aggregate per
# L-BFGS step; a single tree: one per level) are scheduling-bound with
# small tasks, while a forest does ~100x the work per row and wants every
# core.  At cluster scale the cap (the session's parallelism) dominates.
ROWS_PER_TASK = {"logistic_regression": 50_000, "decision_tree": 35_000, "random_forest": 10_000}

# Up to this many rows are fitted one by one; beyond, equal rows are fitted in
# blocks of equal size (``in_blocks``), so that a fit costs the same at any size.
FIT_ROWS = 200_000
WEIGHT = "weight"


def block_size(rows: int, most: int | None = None) -> int:
    """Rows of one block, so that ``rows`` make about ``most`` (``FIT_ROWS``) blocks."""
    return max(1, -(-rows // (most or FIT_ROWS)))


def in_blocks(df: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """Rows that are equal in ``columns`` as blocks of ``size`` rows, the last of
    them smaller: ``columns``, ``block`` and ``weight`` (its rows).  No row is
    left out: the weights sum to the rows.  Rows without equals stay as they
    are.  Weighted sums (gradients, impurities, confusion counts) are those of
    the rows; a forest's bootstrap draws blocks."""
    if size == 1:
        return df.withColumn(WEIGHT, F.lit(1.0))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    last = F.ceil(F.col("_n") / size)
    weight = F.when(F.col("block") < last, F.lit(float(size))).otherwise(F.col("_n") - (last - 1) * size)
    return (counted.withColumn("block", F.explode(F.sequence(F.lit(1).cast("bigint"), last)))
            .withColumn(WEIGHT, weight.cast("double")).drop("_n"))


def task_count(rows: int, family: str, cap: int) -> int:
    """Tasks for ``rows`` training rows of ``family``, at most ``cap``."""
    return max(1, min(cap, -(-rows // ROWS_PER_TASK.get(family, 10_000))))


def feature_prep(category: str = CATEGORY, features: Sequence[str] = FEATURES,
                 out: str = "features") -> Pipeline:
    """M2-M4: frequency index of the area (unseen areas kept in an extra
    bucket), assemble, standardize (mean 0, sample sd 1)."""
    index_col = features[0]
    return Pipeline(stages=[
        StringIndexer(inputCol=category, outputCol=index_col, handleInvalid="keep",
                      stringOrderType="frequencyDesc"),
        VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="error"),
        StandardScaler(inputCol="features_raw", outputCol=out, withMean=True, withStd=True),
    ])


def _bucket(keys: Sequence[str | Column], seed: int, buckets: int) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.pmod(hash32(*cols, seed=seed), F.lit(buckets))


def stable_split(df: DataFrame, keys: Sequence[str | Column], train_fraction: float = TRAIN_FRACTION,
                 seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """M6: a 70/30 split that is a pure function of each row's key."""
    cut = int(round(train_fraction * 10_000))
    b = _bucket(keys, seed, 10_000)
    return df.filter(b < cut), df.filter(b >= cut)


def with_split(df: DataFrame, keys: Sequence[str | Column], train_fraction: float = TRAIN_FRACTION,
               seed: int = SEED, out: str = "split") -> DataFrame:
    cut = int(round(train_fraction * 10_000))
    return df.withColumn(out, F.when(_bucket(keys, seed, 10_000) < cut, F.lit("train"))
                         .otherwise(F.lit("validation")))


def with_folds(df: DataFrame, keys: Sequence[str | Column], folds: int = FOLDS, seed: int = SEED,
               out: str = "fold") -> DataFrame:
    """Stable fold ids in [0, folds) for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(out, _bucket(keys, seed + 1, folds).cast("int"))


def estimator(family: str, label: str = LABEL, features: str = "features", seed: int = SEED):
    if family == "logistic_regression":
        return LogisticRegression(featuresCol=features, labelCol=label, maxIter=LOGISTIC_MAX_ITER,
                                  family="multinomial")
    # Tree execution knobs only (same model): bigger node batches per pass
    # over the data, and node ids cached with the rows for deep trees.
    tree_exec = dict(maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)
    if family == "random_forest":
        return RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, **tree_exec)
    if family == "decision_tree":
        return DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=seed, **tree_exec)
    raise ValueError(f"unknown model family {family!r}")


def param_grid(est, grid: dict[str, list]):
    """The cartesian grid over the named params."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    return b.build()


def confusion(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction",
              weight: str | None = None) -> DataFrame:
    """(y, p, count): rows, or the sum of their weights, by true and predicted class."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return predictions.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(n.alias("count"))


def classification_metrics(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction",
                           weight: str | None = None) -> dict[str, float]:
    """Accuracy and label-weighted precision, recall and F1.

    One aggregate job builds the confusion counts (classes^2 rows at most);
    the weighted averages use the true-label frequencies, as Spark's
    ``weightedPrecision``/``weightedRecall``/``f1`` do.
    """
    cells = confusion(predictions, label, prediction, weight).collect()
    total = sum(r["count"] for r in cells)
    if total == 0:
        return {"accuracy": 0.0, "weightedPrecision": 0.0, "weightedRecall": 0.0, "f1": 0.0}
    labels = sorted({r["y"] for r in cells} | {r["p"] for r in cells})
    tp = {c: 0 for c in labels}
    true_n = {c: 0 for c in labels}
    pred_n = {c: 0 for c in labels}
    for r in cells:
        true_n[r["y"]] += r["count"]
        pred_n[r["p"]] += r["count"]
        if r["y"] == r["p"]:
            tp[r["y"]] += r["count"]
    wp = wr = wf = 0.0
    for c in labels:
        w = true_n[c] / total
        prec = tp[c] / pred_n[c] if pred_n[c] else 0.0
        rec = tp[c] / true_n[c] if true_n[c] else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        wp, wr, wf = wp + w * prec, wr + w * rec, wf + w * f1
    return {"accuracy": sum(tp.values()) / total, "weightedPrecision": wp,
            "weightedRecall": wr, "f1": wf}


@dataclass
class TuneResult:
    family: str
    model: PipelineModel
    metrics: dict[str, float]
    best_params: dict[str, float]
    training_time: float
    grid_size: int
    extra: dict = field(default_factory=dict)


def tune(family: str, train: DataFrame, validation: DataFrame, grid: dict[str, list] | None = None,
         label: str = LABEL, features: str = "features", fold_col: str = "fold",
         folds: int = FOLDS, parallelism: int = 4, seed: int = SEED,
         weight: str | None = None) -> TuneResult:
    """K-fold grid search on ``train`` (folds from ``fold_col``),
    refit of the best point on all of ``train``, scored on ``validation``.
    ``training_time`` is the wall clock of the search and refit.  ``weight``
    names the rows that a row stands for, in fits and in scores."""
    est = estimator(family, label, features, seed)
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    if weight is not None:
        est, evaluator = est.setWeightCol(weight), evaluator.setWeightCol(weight)
    grid = GRIDS[family] if grid is None else grid
    maps = param_grid(est, grid)
    cv = CrossValidator(estimator=Pipeline(stages=[est]), estimatorParamMaps=maps,
                        evaluator=evaluator,
                        numFolds=folds, foldCol=fold_col, parallelism=min(parallelism, len(maps)),
                        seed=seed)
    t0 = time.perf_counter()
    cv_model = cv.fit(train)
    elapsed = time.perf_counter() - t0
    best = cv_model.bestModel
    stage = best.stages[-1]
    params = {name: stage.getOrDefault(stage.getParam(name)) for name in grid}
    metrics = classification_metrics(best.transform(validation), label, weight=weight)
    return TuneResult(family, best, metrics, params, elapsed, len(maps),
                      {"cv_accuracy": max(cv_model.avgMetrics)})
