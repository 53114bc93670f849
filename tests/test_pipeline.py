import dataclasses

import pytest

from dealgauge.operators.lead_models import ModelSettings
from dealgauge.plans.pipeline import Pipeline
from dealgauge.plans.workspace import GIVEN_TABLES
from dealgauge.sources.files import PUBLISHED_TABLES

# The full sizes take minutes whatever the rows; the steps are the same.
SMALL_MODELS = ModelSettings(forest_trees=20, forest_depth=6, boost_rounds=8, arm_rounds=5)


@pytest.fixture(scope="module")
def finished(spark, given, tmp_path_factory):
    pipeline = Pipeline(spark, str(tmp_path_factory.mktemp("tables")), dataclasses.replace(GIVEN_TABLES, models=SMALL_MODELS))
    seconds = pipeline.run(given.raw)
    return pipeline, seconds


def test_stages_ran(finished):
    assert set(finished[1]) == {
        "load_bronze", "clean_to_silver", "build_gold", "train_ml_models", "survival_analysis", "uplift_modeling", "clv_modeling"}


def test_tables_equal_the_lazy_ones(finished, given):
    pipeline, _ = finished
    for name, rows in {**given.clean, "lead_summary": given.summary, "activities_rejected": given.rejected}.items():
        assert pipeline.table(name).exceptAll(rows).count() == 0 and pipeline.table(name).count() == rows.count()


def test_predictions_have_one_row_per_lead(finished):
    pipeline, _ = finished
    leads = pipeline.table("lead_summary").count()
    assert pipeline.table("ml_lead_scores").count() == leads
    assert pipeline.table("ml_clv_predictions").select("lead_id").distinct().count() == leads
    assert set(pipeline.table("ml_clv_predictions").columns) == {
        "lead_id", "conversion_probability", "effective_deal_value", "median_years", "discount_factor", "clv_discounted",
        "clv_undiscounted", "clv_tier", "industry", "lead_source", "region", "discount_rate", "model_version", "scored_at"}
    assert set(pipeline.table("ml_uplift_predictions").columns) == {
        "lead_id", "treatment_group", "event_converted", "p_treatment", "p_control", "uplift", "uplift_segment", "industry",
        "lead_source", "region", "scored_at"}
    assert pipeline.table("ml_survival_predictions").columns == ["lead_id", "predicted_median_days", "survival_model", "scored_at"]


def test_summaries_and_models_are_read_back(finished, spark):
    from pyspark.ml import PipelineModel

    from dealgauge.operators import cox, lead_models

    pipeline, _ = finished
    metrics = pipeline.summary("model_metrics")
    assert metrics.filter("selected").count() == 1 and metrics.count() == 3
    assert {r["line"] for r in pipeline.summary("model_class_report").collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert pipeline.summary("model_features").count() == 9
    leads = pipeline.table("lead_summary").count()
    for name in ("risk_tier_counts", "uplift_segment_counts"):
        assert 0 < pipeline.summary(name).agg({"leads": "sum"}).first()[0] <= leads
    assert pipeline.summary("survival_cohort").first()["leads"] == pipeline.table("survival_rows").count()
    model = cox.load_model(spark, f"{pipeline.target}/models/cox")
    again = cox.predicted_medians(pipeline.table("survival_rows"), model)
    assert again.exceptAll(pipeline.table("survival_scores").select(again.columns)).count() == 0
    arms = {arm: PipelineModel.load(f"{pipeline.target}/models/uplift_{arm.lower()}") for arm in lead_models.ARMS}
    scored = lead_models.score_two_arms(lead_models.UpliftRun(arms, None), pipeline.table("campaign_cohort"))
    both = scored.select("lead_id", "uplift").join(pipeline.table("uplift_scores").selectExpr("lead_id", "uplift AS before"), "lead_id")
    assert both.count() == scored.count() and both.filter("abs(uplift - before) > 1e-12").count() == 0
    best = metrics.filter("selected").first()["model"].lower().replace(" ", "_")
    assert PipelineModel.load(f"{pipeline.target}/models/{best}").transform(pipeline.table("scoring_features")).count() == leads


def test_views(finished, spark):
    assert spark.table("vw_survival_input").count() > 0
    assert spark.table("vw_lead_summary_scored").filter("risk_tier is null").count() == 0


def test_from_csv_with_missing_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "raw_leads.csv").write_text(
        "lead_id,contact_name,company_name,industry,company_size,lead_source,job_title,country,region,status,created_date\n"
        "L1,A,Acme,SaaS,163 emp,Referral,CEO,France,Europe,Converted,2020-01-01\n")
    pipeline = Pipeline(spark, str(tmp_path / "tables"))
    pipeline.load_bronze(str(raw))
    pipeline.clean_to_silver()
    pipeline.build_gold()
    row = pipeline.table("lead_summary").first()
    assert (row["company_size"], row["total_activities"], row["duration_days"], row["has_opportunity"]) == (163, 0, 2440, False)
    assert pipeline.table("activities_rejected").count() == 0

    # one valid activity, no rejects
    (raw / "raw_activities.csv").write_text(
        "activity_id,lead_id,activity_date,activity_type,channel,outcome\nT1,L1,2020-01-02,call,Phone,Neutral\n")
    pipeline.load_bronze(str(raw))
    pipeline.clean_to_silver()
    pipeline.build_gold()
    assert pipeline.table("lead_summary").first()["total_activities"] == 1
    assert pipeline.table("activities_rejected").count() == 0 and pipeline.table("fact_activities").count() == 1


def test_publish(finished, spark, tmp_path):
    assert finished[0].publish(str(tmp_path)) == PUBLISHED_TABLES
    assert spark.read.parquet(str(tmp_path / "activities_clean")).count() == finished[0].table("activities_clean").count()
