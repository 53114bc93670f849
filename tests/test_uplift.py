import numpy as np
import pytest

from dealgauge.operators import lead_models, uplift


@pytest.fixture(scope="module")
def cohort(spark):
    """The campaign helps 'Good' leads and harms 'Bad' ones."""
    rng = np.random.default_rng(7)
    n = 1200
    source, treated = rng.choice(["Good", "Bad"], n), rng.integers(0, 2, n)
    p = 0.4 + np.where(source == "Good", 0.3, -0.3) * treated
    events = (rng.random(n) < p).astype(int)
    rows = [
        (f"L{i:04d}", "Treatment" if treated[i] else "Control", int(events[i]), int(rng.integers(0, 5)), int(rng.integers(1, 50)),
         "I", str(source[i]), "R", "J") for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "lead_id string, treatment_group string, event_converted int, total_activities int, company_size int, "
        "industry string, lead_source string, region string, job_title string").cache()


def test_cohort_filter(spark):
    rows = spark.createDataFrame(
        [("a", True, "Treatment"), ("b", False, "Treatment"), ("c", True, "Other"), ("d", True, None)],
        "lead_id string, received_campaign boolean, treatment_group string")
    for c in ("event_converted", "total_activities", "company_size", "industry", "lead_source", "region", "job_title"):
        rows = rows.selectExpr("*", f"1 as {c}")
    assert [r["lead_id"] for r in uplift.campaign_cohort(rows).collect()] == ["a"]


def test_segment_rates_find_the_effect(cohort):
    got = uplift.with_segment(uplift.segment_rate_scores(cohort)).groupBy("lead_source", "uplift_segment").count().collect()
    assert {(r[0], r[1]) for r in got} == {("Good", "Persuadable"), ("Bad", "Do Not Disturb")}


@pytest.mark.parametrize("limit", [10**6, 50])
def test_qini(cohort, limit):
    scores = uplift.segment_rate_scores(cohort)
    got = uplift.qini_curve(scores, limit=limit).toPandas().sort_values("fraction")
    data = scores.toPandas().sort_values(["uplift", "lead_id"], ascending=[False, True])
    treated = data["treatment_group"] == "Treatment"
    ratio = treated.sum() / (~treated).sum()
    fractions = np.linspace(0.05, 1, 25)
    expected = []
    for f in fractions:
        head = data.iloc[: int(f * len(data))]
        hit = head["event_converted"] == 1
        in_treatment = head["treatment_group"] == "Treatment"
        expected.append((hit & in_treatment).sum() - (hit & ~in_treatment).sum() * ratio)
    assert np.allclose(got["fraction"], fractions) and np.allclose(got["qini"], expected)
    # everyone targeted: the plain difference; the random line ends there too
    assert got["qini"].iloc[-1] == pytest.approx(got["random"].iloc[-1])
    assert got["qini"].max() > got["random"].max()


def test_qini_without_controls(spark):
    rows = spark.createDataFrame([("a", 0.5, "Treatment", 1), ("b", 0.1, "Treatment", 0)], "lead_id string, uplift double, treatment_group string, event_converted int")
    got = uplift.qini_curve(rows).toPandas().sort_values("fraction")
    assert got["qini"].iloc[-1] == 1.0 and len(got) == 25


def test_two_arm_models_find_the_sign(cohort):
    run = lead_models.train_two_arms(cohort, lead_models.ModelSettings(arm_rounds=40, arm_depth=2))
    assert {r["treatment_group"] for r in run.metrics.collect()} == {"Treatment", "Control"}
    means = {r[0]: r[1] for r in lead_models.score_two_arms(run, cohort).groupBy("lead_source").avg("uplift").collect()}
    assert means["Good"] > 0.1 and means["Bad"] < -0.1


def test_summary_counts_add_up(cohort):
    row = uplift.uplift_summary(uplift.with_segment(uplift.segment_rate_scores(cohort))).first()
    assert row["n_persuadable"] + row["n_sure_thing"] + row["n_lost_cause"] + row["n_do_not_disturb"] == row["n_leads"]
