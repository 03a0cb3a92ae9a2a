"""Estimators, search and statistics on small made-up rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wagerlens.operators import modelling as M


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    out = []
    for i in range(400):
        y = int(r.random() < 0.4)
        out.append((i, r.gauss(2 * y, 1), r.gauss(0, 1), r.choice("ab"), y, i % 2))
    return spark.createDataFrame(out, "player long, x double, z double, c string, y int, fold int").cache()


def right(df):
    return df.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]


@pytest.mark.parametrize("model", ["bagging_tree", "sgd_logloss", "adaboost", "focal_boosting", "linear_svc_cal"])
def test_estimators_learn(rows, model):
    params = {"rounds": 3} if model in ("adaboost", "focal_boosting") else {}
    fitted = M.fit_steps(rows, ["x", "z"], model, "y", **params)
    scored = fitted.transform(rows)
    assert right(scored) > 0.78
    assert {"rawPrediction", "probability", "prediction"} <= set(scored.columns)


def test_focal_slopes_are_those_of_the_loss(spark):
    def loss(s, y, gamma):
        q = 1 / (1 + math.exp(-(2 * y - 1) * s))
        return -((1 - q) ** gamma) * math.log(q)

    for s, y, gamma in ((0.3, 1, 2.0), (-1.2, 1, 2.0), (0.7, 0, 1.5), (2.0, 1, 0.0)):
        df = spark.createDataFrame([(s, float(y))], "s double, y double")
        slope, curve = df.select(*M.focal_slopes(F.col("s"), F.col("y"), gamma)).first()
        e = 1e-4
        up, down = loss(s + e, y, gamma), loss(s - e, y, gamma)
        assert abs((up - down) / (2 * e) - slope) < 1e-6
        assert abs(max(1e-6, (up - 2 * loss(s, y, gamma) + down) / e**2) - curve) < 1e-4


def test_search_learns_where_to_look(rows):
    space = {"logistic": {"regParam": (1e-4, 10.0, "log"), "maxIter": [3]}}
    asked = M.ParzenSearch(space, 3, first=[{"model": "logistic", "regParam": 0.1, "maxIter": 3}, {"model": "logistic", "bad": 1}])
    found = M.search(rows, ["x"], "y", asked, folds=2)
    assert len(found) == 3 and "error" in found[-1] and found[0]["areaUnderPR_mean"] > 0.7
    assert len(M.search(rows, ["x"], "y", [{"model": "logistic", "maxIter": 2}] * 5, folds=2, seconds=0)) == 1
    again = M.revalidated(rows, rows.filter("fold = 0"), ["x"], "y", found, top=1, folds=2)
    assert again[0]["test_areaUnderROC"] > 0.8
    dense = M.ParzenSearch({"m": {"a": (0.0, 1.0)}}, 60, seed=3)
    tried = []
    while (t := dense.ask()) is not None:
        tried.append(t["a"])
        dense.tell(t, -abs(t["a"] - 0.7))
    assert sum(abs(a - 0.7) for a in tried[40:]) / 20 < sum(abs(a - 0.7) for a in tried[:10]) / 10


def test_importances_and_significance(rows):
    for model in ("decision_tree", "logistic", "linear_svc_cal"):
        assert M.importances(M.fit_steps(rows, ["z", "x"], model, "y"), rows, ["z", "x"], "y")[0][0] == "x"
    got = {r["name"]: r for r in M.significance(rows, ["x", "z"], "y").collect()}
    assert got["x"].p < 1e-6 and got["x"].mean_1 > 1.5 and got["z"].p > 0.001 and 100 < got["x"].freedom < 400
    chi = M.chi_squares(rows, ["c"], "y").first()
    plain = rows.groupBy("c", "y").count().collect()
    n = {(r.c, r.y): r["count"] for r in plain}
    want = sum((n[c, y] - (n[c, 0] + n[c, 1]) * (n["a", y] + n["b", y]) / 400) ** 2 / ((n[c, 0] + n[c, 1]) * (n["a", y] + n["b", y]) / 400) for c in "ab" for y in (0, 1))
    assert abs(chi.statistic - want) < 1e-9 and chi.freedom == 1


def test_made_up_positives_lie_between_known_ones(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(i, r.uniform(5, 6) if i < 20 else r.uniform(-1, 1), 1 if i < 20 else 0) for i in range(420)], "player long, x double, y int")
    out = M.smote(df, ["x"], "y", share=0.2)
    made = out.filter("player is null")
    assert made.count() >= 60 and out.filter("player is not null").count() == 420
    assert made.filter("x < 5 or x > 6 or y <> 1").count() == 0
    assert M.smote(df, ["x"], "y", share=0.01).count() == 420


def test_tasks_and_validation_rows(rows):
    assert len(M.tasks(["a", "b"], ["m"], ["v"], {"m": [{"k": 1}, {"k": 2}]})) == 4
    share = M.validation_rows(rows, "player").agg(F.avg(F.col("validation").cast("double"))).first()[0]
    assert 0.05 < share < 0.3
