"""Validation that does not see what it is scored on.

Label and features of a row are functions of its cell (area, year), so rows of
one cell must stand on one side.  Two ways:

* by group: a split and folds that are functions of the group's key alone;
* by time (rolling origin): for each of the last years, models are trained on
  all earlier years and scored on that year.  Class cuts and feature
  preparation are fitted on the earlier years only, as they would have been.

Both are pure functions of the rows: no sampling, no dependence on partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.operators.models import (FOLDS, GRIDS, LABEL, SEED, TRAIN_FRACTION, classification_metrics, estimator,
                                     param_grid, with_folds, with_split)

ORIGINS = 3


def with_group_folds(df: DataFrame, groups: Sequence[str], train_fraction: float = TRAIN_FRACTION, folds: int = FOLDS,
                     seed: int = SEED) -> DataFrame:
    """``split`` (train or validation) and ``fold`` (null outside train) of each
    row, the same for all rows of a group."""
    out = with_folds(with_split(df, groups, train_fraction, seed), groups, folds, seed)
    return out.withColumn("fold", F.when(F.col("split") == "train", F.col("fold")))


def shared_groups(df: DataFrame, groups: Sequence[str], side: str = "split") -> DataFrame:
    """Groups with rows on more than one side: none, if nothing leaks."""
    return df.groupBy(*groups).agg(F.count_distinct(side).alias("sides")).where("sides > 1")


def origin_times(df: DataFrame, time: str, origins: int = ORIGINS) -> list:
    """The last ``origins`` times that have earlier ones (a handful of values)."""
    times = [r[0] for r in df.where(F.col(time).isNotNull()).select(time).distinct().orderBy(F.desc(time))
             .limit(origins + 1).collect()]
    return sorted(times)[1:] if len(times) <= origins else sorted(times)[-origins:]


def with_origins(df: DataFrame, time: str, times: Sequence) -> DataFrame:
    """A row for each origin that uses it: ``origin`` (the time scored) and
    ``side``: train before it, validation at it."""
    origin = F.explode(F.filter(F.array(*[F.lit(t) for t in times]), lambda t: F.col(time) <= t))
    return df.withColumn("origin", origin).withColumn(
        "side", F.when(F.col(time) < F.col("origin"), "train").otherwise("validation"))


@dataclass
class Origin:
    time: object
    params: dict
    metrics: dict[str, float]


@dataclass
class RollingResult:
    family: str
    best_params: dict
    mean_accuracy: float
    origins: list[Origin]
    model: PipelineModel | None = None


def rolling_search(family: str, frame: DataFrame, time: str, prepare: Callable[[DataFrame, DataFrame], tuple],
                   origins: int = ORIGINS, grid: dict[str, list] | None = None, label: str = LABEL,
                   weight: str | None = None) -> RollingResult:
    """The grid point with the best mean accuracy over the origins.

    ``prepare(train, validation)`` fits what must be fitted on the train rows
    and returns both sides with ``features``, the label and ``weight``, if named:
    the rows that a row stands for.
    """
    est, grid = estimator(family, label), GRIDS[family] if grid is None else grid
    if weight is not None:
        est = est.setWeightCol(weight)
    maps = param_grid(est, grid)
    found: list[Origin] = []
    for t in origin_times(frame, time, origins):
        train, validation = prepare(frame.where(F.col(time) < t), frame.where(F.col(time) == t))
        for i, model in est.fitMultiple(train, maps):
            params = {p.name: v for p, v in maps[i].items()}
            found.append(Origin(t, params, classification_metrics(model.transform(validation), label, weight=weight)))
    if not found:
        raise ValueError(f"no {time!r} has earlier ones to train on")
    mean = {}
    for m in maps:
        params = {p.name: v for p, v in m.items()}
        scores = [o.metrics["accuracy"] for o in found if o.params == params]
        mean[tuple(sorted(params.items()))] = sum(scores) / len(scores)
    best = max(mean, key=lambda k: mean[k])              # of equals the first of the grid
    return RollingResult(family, dict(best), mean[best], [o for o in found if o.params == dict(best)])
