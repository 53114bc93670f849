"""Logistic regression against a plain Newton fit, and its round trip through a file."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dealgauge.operators import scoring
from dealgauge.operators.logistic import fit_logistic


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = np.random.default_rng(6)
    n = 400
    a, kind = rng.normal(20, 5, n).round(2), rng.choice(["x", "y", "z"], n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.2 * (a - 20) + 1.0 * (kind == "y"))))).astype(int)
    rows = [(f"L{i}", float(a[i]) if i % 11 else None, 1.0, str(kind[i]) if i % 13 else None, int(y[i])) for i in range(n)]
    path = str(tmp_path_factory.mktemp("logistic") / "rows")
    spark.createDataFrame(rows + rows[:50], "lead_id string, a double, constant double, kind string, y int").write.parquet(path)
    return spark.read.parquet(path), rows + rows[:50]


def plain_newton(rows, weights, penalty):
    a = np.array([np.nan if r[1] is None else r[1] for r in rows])
    a[np.isnan(a)] = np.nanmedian(a)
    kinds = sorted({r[3] or "Unknown" for r in rows})
    x = np.column_stack([np.ones(len(rows)), (a - a.mean()) / a.std(), np.zeros(len(rows)), *[[float((r[3] or "Unknown") == k) for r in rows] for k in kinds]])
    y, beta, shrink = np.array([r[4] for r in rows]), np.zeros(x.shape[1]), np.diag([0.0, *[penalty] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta + np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + shrink, x.T @ (weights * (y - p)) - shrink @ beta)
    return beta, 1 / (1 + np.exp(-x @ beta)), ["intercept", "a", "constant", *[f"kind_{k}" for k in kinds]]


@pytest.mark.parametrize("positive_weight", [1.0, 3.5])
def test_equals_plain_newton(data, positive_weight):
    frame, rows = data
    model = fit_logistic(frame, ["a", "constant"], ["kind"], "y", F.when(F.col("y") == 1, positive_weight).otherwise(1.0))
    weights = np.array([positive_weight if r[4] else 1.0 for r in rows])
    beta, p, names = plain_newton(rows, weights, 1.0)
    assert [n for n, _ in model.coefficients()] == names
    assert np.allclose([w for _, w in model.coefficients()], beta, atol=1e-8)
    scored = {r["lead_id"]: r["p"] for r in frame.select("lead_id", model.positive().alias("p")).collect()}
    assert np.allclose([scored[r[0]] for r in rows], p, atol=1e-9)


def test_saved_model_scores_alike_and_unseen_values_count_nothing(data, tmp_path):
    frame, _ = data
    model = PipelineModel(stages=[fit_logistic(frame, ["a"], ["kind"], "y")])
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    both = model.transform(frame).select("lead_id", "probability").collect()
    assert both == loaded.transform(frame).select("lead_id", "probability").collect()
    odd = frame.limit(1).withColumn("kind", F.lit("never seen")).withColumn("a", F.lit(None).cast("double"))
    told = loaded.stages[0].told()
    expected = told["intercept"] + told["numbers"][0]["weight"] * (told["numbers"][0]["fill"] - told["numbers"][0]["mean"]) / told["numbers"][0]["sd"]
    assert abs(loaded.transform(odd).first()["probability"][1] - 1 / (1 + np.exp(-expected))) < 1e-12


def test_no_rows_and_separable_rows(spark, data):
    frame, _ = data
    with pytest.raises(ValueError):
        fit_logistic(frame.limit(0), ["a"], ["kind"], "y")
    apart = spark.createDataFrame([(float(i), "k", int(i > 5)) for i in range(12)], "a double, kind string, y int")
    p = [r[0] for r in apart.orderBy("a").select(fit_logistic(apart, ["a"], ["kind"], "y").positive()).collect()]
    assert p == sorted(p) and p[0] < 0.2 < 0.8 < p[-1]


def test_mann_whitney_with_ties(spark):
    rng = np.random.default_rng(1)
    s, y = rng.integers(0, 8, 200) / 8, rng.integers(0, 2, 200)
    frame = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)] + [(None, 1), (0.5, None)], "conversion_probability double, event_converted int")
    got = scoring.mann_whitney(frame).first()
    above, below = s[y == 1][:, None], s[y == 0][None]
    assert abs(got["auc"] - ((above > below).sum() + (above == below).sum() / 2) / above.size / below.size) < 1e-12
    assert scoring.mann_whitney(frame.filter("event_converted = 1")).first()["auc"] is None
    assert scoring.mann_whitney(frame.limit(0)).first().asDict() == {"positives": 0, "negatives": 0, "auc": None}


def test_class_report_by_hand(spark):
    counts = spark.createDataFrame([(3, 1, 2, 4)], "tp long, fp long, fn long, tn long")
    got = {r["line"]: tuple(r[1:]) for r in scoring.class_report(counts).collect()}
    assert got["0"] == (0.6667, 0.8, 0.7273, 5) and got["1"] == (0.75, 0.6, 0.6667, 5)
    assert got["accuracy"] == (0.7, 0.7, 0.7, 10) and got["macro avg"] == (0.7083, 0.7, 0.697, 10) == got["weighted avg"]
    nothing = {r["line"]: r["f1"] for r in scoring.class_report(spark.createDataFrame([(0, 0, 0, 0)], counts.schema)).collect()}
    assert set(nothing.values()) == {0.0}
