import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from barrio.operators.models import (classification_metrics, feature_prep, stable_split, tune,
                                     with_folds)
from barrio.operators.registry import (accuracy_report, champion, leaderboard, metrics_wide, register,
                                       save_model, score)
from barrio.operators.models import TuneResult


def test_classification_metrics_match_spark_evaluator(spark):
    data = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (2.0, 2.0)]
    df = spark.createDataFrame(data, "price_category double, prediction double")
    got = classification_metrics(df)
    for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        ev = MulticlassClassificationEvaluator(labelCol="price_category", metricName=name)
        assert got[name] == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_stable_split_and_folds(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    tr, va = stable_split(df, ["k"])
    a, b = {r.k for r in tr.collect()}, {r.k for r in va.collect()}
    assert not a & b and len(a | b) == 2000 and 0.65 < len(a) / 2000 < 0.75
    tr2, _ = stable_split(df.repartition(7), ["k"])
    assert {r.k for r in tr2.collect()} == a
    folds = {r.fold for r in with_folds(df, ["k"]).collect()}
    assert folds == {0, 1, 2}


def _frame(spark):
    rows = []
    for i in range(300):
        area = f"a{i % 5}"
        year = 2015 + i % 4
        rows.append((i, area, year, i % 3, i % 4, i % 2, i % 5, i % 7, i % 3, float(i % 11),
                     float((i % 5 + year) % 3)))
    cols = ("k long, neighborhood_name string, year int, accident_deaths long, number_injured_lleus long, "
            "number_injured_greu long, number_accident_victims long, number_of_accidents long, "
            "number_of_cultural_sites long, average_antiquity_cultural_sites double, price_category double")
    return spark.createDataFrame(rows, cols)


def test_tune_small_grid_structure(spark, tmp):
    df = _frame(spark)
    tr, va = stable_split(df, ["k"])
    prep = feature_prep().fit(tr)
    train = with_folds(prep.transform(tr), ["k"])
    res = tune("decision_tree", train, prep.transform(va), grid={"maxDepth": [2, 5]})
    assert res.grid_size == 2 and set(res.best_params) == {"maxDepth"}
    assert 0.0 <= res.metrics["accuracy"] <= 1.0 and res.training_time > 0
    from pyspark.ml import PipelineModel
    path = save_model(PipelineModel(stages=[*prep.stages, *res.model.stages]), f"{tmp}/m")
    scored = score(path, va)
    assert scored.count() == va.count() and "prediction" in scored.columns


PUBLISHED = {  # fixed values: the published results table
    "decision_tree": (0.768595, 0.780813, 0.768595, 0.772133, 72.907664),
    "random_forest": (0.690083, 0.697307, 0.690083, 0.693158, 136.004502),
    "logistic_regression": (0.623967, 0.609994, 0.623967, 0.612617, 160.040482),
}


def _published():
    out = []
    for fam, (acc, prec, rec, f1, t) in PUBLISHED.items():
        out.append(TuneResult(fam, None, {"accuracy": acc, "weightedPrecision": prec, "weightedRecall": rec,
                                          "f1": f1}, {}, t, 0))
    return out


def test_leaderboard_champion_reports(spark, tmp):
    board = leaderboard(spark, _published())
    assert board.count() == 12
    assert champion(board).first()["model"] == "Decision Tree"
    rep = accuracy_report(board).collect()
    assert [r["model"] for r in rep] == ["Decision Tree", "Random Forest", "Logistic Regression"]
    assert rep[0]["axis_max"] == pytest.approx(0.968595)
    wide = {r["model"]: r for r in metrics_wide(board).collect()}
    assert wide["Random Forest"]["Precision"] == pytest.approx(0.697307)
    reg = register(spark, board, f"{tmp}/reg")
    assert {r["version"] for r in reg.collect()} == {1}
    assert {r["version"] for r in register(spark, board, f"{tmp}/reg").collect()} == {2}


def test_champion_tie_goes_to_earlier_trained(spark):
    res = _published()
    for r in res:
        r.metrics["accuracy"] = 0.5
    assert champion(leaderboard(spark, res)).first()["model"] == "Logistic Regression"
