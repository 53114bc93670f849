import pytest

import __spark_entry__ as entry_points

from given_tables import TESTDATA

MODEL_QUERIES = {
    "scoring_metrics", "class_report", "lead_scores", "model_comparison", "uplift_arm_metrics", "uplift_scores",
    "model_qini_curve", "cox_hazard_ratios", "cox_report", "cox_concordance", "survival_predictions",
    "survival_prediction_stats", "fastest_leads", "prediction_histogram", "clv_predictions",
}


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - MODEL_QUERIES))
def test_plan(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, TESTDATA))
    for unwanted in ("PythonUDF", "EvalPython", "CartesianProduct", "NestedLoop", "MapInPandas"):
        assert unwanted not in plan


def test_reports_read_only_their_columns(spark):
    plan = plan_of(entry_points.queries()["status_distribution"](spark, TESTDATA))
    assert "ReadSchema: struct<lead_id:string,status:string>" in plan


def test_point_lookup_is_pushed_down(spark):
    plan = plan_of(entry_points.queries()["customer_360"](spark, TESTDATA))
    assert "EqualTo(lead_id,L7)" in plan


def test_summary_joins_only_on_the_lead(given):
    from dealgauge.operators import star

    rows = star.lead_summary(given.leads, given.activities, given.opportunities, given.touches, given.parameters.snapshot)
    plan = plan_of(rows)
    assert "ReadSchema: struct<lead_id:string,activity_date:date>" in plan
    assert "PartitionFilters: [isnull(rejection_reason" in plan
