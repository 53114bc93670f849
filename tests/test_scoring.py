import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from dealgauge.operators import clv, lead_models, scoring


def test_required_columns(spark):
    with pytest.raises(ValueError):
        scoring.select_features(spark.createDataFrame([("L1",)], "lead_id string"))


def test_tiers_split_20_60_20_and_losses(spark):
    rows = spark.createDataFrame([(f"L{i}", i / 1000, 100.0) for i in range(1000)], "lead_id string, conversion_probability double, deal_value double")
    out = scoring.business_outputs(rows).cache()
    counts = {r["risk_tier"]: r["leads"] for r in scoring.tier_counts(out, "risk_tier", scoring.RISK_TIERS).collect()}
    assert counts == {"Low": 200, "Medium": 600, "High": 200}
    assert out.filter("lead_id = 'L250'").first()["expected_loss"] == 75.0


def test_absent_tier_counts_zero(spark):
    rows = spark.createDataFrame([("Low",)], "risk_tier string")
    got = [(r["risk_tier"], r["leads"]) for r in scoring.tier_counts(rows, "risk_tier", scoring.RISK_TIERS).orderBy("position").collect()]
    assert got == [("Low", 1), ("Medium", 0), ("High", 0)]


def test_metrics_without_predictions_are_zero(spark):
    rows = spark.createDataFrame([(0.1, 1), (0.2, 0)], "conversion_probability double, event_converted int")
    got = scoring.confusion_metrics(rows).first()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_calibration_leaves_zero_out(spark):
    rows = spark.createDataFrame([("a", 0.0, 1), ("b", 0.2, 1), ("c", 1.0, 0)], "lead_id string, conversion_probability double, event_converted int")
    got = {r["prob_bin"]: (r["leads"], r["actual"]) for r in scoring.calibration(rows).collect()}
    assert got == {"0-20%": (1, 1.0), "80-100%": (1, 0.0)}


def planted(spark, n=1500):
    rng = np.random.default_rng(3)
    sources, sizes = rng.choice(["Good", "Bad"], n), rng.integers(1, 100, n)
    p = np.where(sources == "Good", 0.7, 0.2) + 0.1 * (sizes > 50)
    events = (rng.random(n) < p).astype(int)
    data = [
        (f"L{i}", int(rng.integers(0, 9)), int(sizes[i]) if i % 20 else None, bool(i % 2), "I", str(sources[i]) if i % 30 else None,
         "R", "J", "Treatment" if i % 2 else None, None, int(events[i]), 10.0)
        for i in range(n)
    ]
    return spark.createDataFrame(
        data, "lead_id string, total_activities int, company_size int, received_campaign boolean, industry string, lead_source string, "
        "region string, job_title string, treatment_group string, campaign_response string, event_converted int, deal_value double")


def test_split_keeps_class_shares_and_is_repeatable(spark):
    rows = planted(spark)
    train, test = lead_models.stratified_split(rows, 0.2, 42)
    again = lead_models.stratified_split(rows, 0.2, 42)[1]
    assert train.count() + test.count() == 1500 and set(test.collect()) == set(again.collect())
    large_train, large_test = lead_models.stratified_split(rows, 0.2, 42)
    assert large_train.count() + large_test.count() == 1500 and large_train.join(large_test, "lead_id").count() == 0
    for label, n in rows.groupBy("event_converted").count().collect():
        assert abs(test.filter(F.col("event_converted") == label).count() - 0.2 * n) <= 1
        assert abs(large_test.filter(F.col("event_converted") == label).count() - 0.2 * n) <= 0.05 * n


def test_unseen_category_is_all_zero(spark):
    seen = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None)], "x double, c string")
    model = Pipeline(stages=lead_models.preprocessing(["x"], ["c"])).fit(seen)
    got = model.transform(spark.createDataFrame([(2.0, "new"), (2.0, "b"), (2.0, None)], "x double, c string"))
    assert [list(r["c_hot"].toArray()) for r in got.collect()] == [[0, 0, 0], [0, 0, 1], [1, 0, 0]]


def test_models_find_a_planted_signal(spark, tmp_path):
    features = scoring.select_features(planted(spark)).cache()
    run = lead_models.train_scoring(features, lead_models.ModelSettings(forest_trees=10, forest_depth=5, boost_rounds=5))
    metrics = run.metrics.collect()
    assert len(metrics) == 3 and min(r["auc"] for r in metrics) > 0.65
    assert [r["model"] for r in metrics if r["selected"]] == [max(metrics, key=lambda r: r["auc"])["model"]]
    assert sum(r["support"] for r in run.report.collect() if r["line"] in ("0", "1")) == pytest.approx(300, abs=2)
    assert lead_models.model_comparison(run.metrics).count() == 15
    scores = lead_models.score_all(run.best_model, features)
    assert scores.count() == 1500
    lead_models.save_model(run.best_model, str(tmp_path / "m"))
    lead_models.save_model(run.best_model, str(tmp_path / "m"))
    reloaded = lead_models.score_all(PipelineModel.load(str(tmp_path / "m")), features)
    assert scores.exceptAll(reloaded).count() == 0


def test_values(spark):
    summary = spark.createDataFrame(
        [("L1", "A", 100.0), ("L2", "A", 300.0), ("L3", "A", None), ("L4", "B", 0.0), ("L5", None, None)],
        "lead_id string, industry string, deal_value double").withColumns({"lead_source": F.lit("s"), "region": F.lit("r")})
    scores = spark.createDataFrame([("L1", 0.5), ("L2", 0.1), ("L3", 0.3), ("L4", 0.3)], "lead_id string, conversion_probability double")
    medians = spark.createDataFrame([("L1", 365.25), ("L2", None), ("L3", 0.0)], "lead_id string, predicted_median_days double")
    got = {r["lead_id"]: r for r in clv.lifetime_values(summary, scores, medians).collect()}
    assert got["L1"]["clv_discounted"] == pytest.approx(50 * np.exp(-0.1)) and not got["L1"]["used_imputed_deal"]
    assert (got["L2"]["median_years"], got["L3"]["median_years"]) == (5.0, 5.0)
    assert (got["L3"]["effective_deal_value"], got["L3"]["used_imputed_deal"]) == (200.0, True)
    # an industry without a positive deal takes the overall median, a missing score the mean score
    assert got["L4"]["effective_deal_value"] == 200.0 and got["L5"]["conversion_probability"] == pytest.approx(0.3)


def test_value_tiers(spark):
    rows = spark.createDataFrame([(f"L{i}", float(i)) for i in range(100)] + [("x", None)], "lead_id string, clv_discounted double")
    tiers = clv.with_value_tier(rows).groupBy("clv_tier").count()
    assert {r[0]: r[1] for r in tiers.collect()} == {"High": 20, "Medium": 30, "Low": 50, "Unscored": 1}


def test_forest_tasks_grow_with_rows_but_not_with_each_two_thousand():
    from dealgauge.operators.lead_models import forest_tasks

    assert [forest_tasks(n) for n in (0, 1999, 12_000, 23_999)] == [1, 1, 7, 12]
    assert forest_tasks(720_000) == 12 and forest_tasks(4_320_000) == 68
