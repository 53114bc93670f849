"""Every query by name, as a function of the workspace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealgauge.operators import clv, cox, kaplan_meier, lead_models, logistic, quality, scoring, star, uplift
from dealgauge.operators.cleaning import cleaning_report, reject_profile
from dealgauge.plans import reports
from dealgauge.plans.workspace import Workspace
from dealgauge.sources.files import stamp
from dealgauge.sources.schemas import TEXT_LIMITS

Query = Callable[[Workspace], DataFrame]

# Amounts are shown with two decimals, every other double with six.
AMOUNTS = {
    "deal_value", "expected_loss", "exposure", "total_exposure", "total_expected_loss", "won_revenue",
    "revenue_difference", "avg_won_deal", "pipeline_value", "avg_value", "effective_deal_value",
    "clv_discounted", "clv_undiscounted", "mean_clv", "total_clv", "avg_clv", "median_clv", "q80_clv", "p90_clv",
    "max_clv", "segment_median", "avg_deal_value", "total_deal_value", "activities_vs_average",
}


def tidy(rows: DataFrame) -> DataFrame:
    """Rounds the doubles, so that the order of additions does not show.

    The small shift moves decimal ties such as 41107.215 off the limit, where binary engines differ.
    """
    return rows.select(*[
        F.round(F.col(f"`{f.name}`") + 1e-9, 2 if f.name in AMOUNTS else 6).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in rows.schema.fields
    ])


RISK_COLUMNS = [
    "lead_id", "company_name", "industry", "region", "status", "total_activities", "duration_days",
    "risk_score", "risk_tier", "expected_loss",
]
TOP_LEAD_COLUMNS = [
    "lead_id", "company_name", "industry", "region", "lead_source", "job_title", "deal_value",
    "conversion_probability", "risk_tier", "expected_loss", "event_converted",
]
TOP_VALUE_COLUMNS = [
    "lead_id", "industry", "lead_source", "region", "conversion_probability", "effective_deal_value",
    "median_years", "discount_factor", "clv_discounted", "clv_tier", "risk_tier", "event_converted",
]
FILTER_COLUMNS = ["region", "industry", "lead_source", "treatment_group", "campaign_response"]


def _layers(w: Workspace) -> dict[str, dict[str, DataFrame]]:
    return {"Bronze": w.raw, "Silver": w.clean, "Gold": w.gold}


def _scored(w: Workspace) -> DataFrame:
    return reports.scored_leads(w.rule_outputs, w.summary)


def _km(w: Workspace, segment: str) -> DataFrame:
    sizes = {"lead_source": w.parameters.largest_sources, "industry": w.parameters.largest_industries}
    return kaplan_meier.by_segment(w.survival, segment, sizes[segment])


def _ranks(w: Workspace) -> DataFrame:
    return reports.activity_and_duration_ranks(w.portfolio).select(
        "lead_id", "total_activities", "activity_rank", "duration_days", "duration_rank")


QUERIES: dict[str, Query] = {
    # raw tables
    "bronze_leads": lambda w: w.raw["raw_leads"],
    "bronze_opportunities": lambda w: w.raw["raw_opportunities"],
    "bronze_activities": lambda w: w.raw["raw_activities"],
    "bronze_campaign_touches": lambda w: w.raw["raw_campaign_touches"],
    "csv_activities": lambda w: w.csv_activities,
    # cleaned tables
    "silver_leads": lambda w: w.clean["leads_clean"],
    "silver_opportunities": lambda w: w.clean["opportunities_clean"],
    "silver_activities": lambda w: w.clean["activities_clean"],
    "silver_touches": lambda w: w.clean["campaign_touches_clean"],
    "activities_rejected": lambda w: w.rejected,
    "cleaning_report": lambda w: cleaning_report(w.raw, {**w.clean, "activities_rejected": w.rejected}),
    "reject_profile": lambda w: reject_profile(w.rejected),
    # star schema
    "dim_time": lambda w: w.covering_calendar,
    "dim_leads": lambda w: w.gold["dim_leads"],
    "fact_activities": lambda w: w.gold["fact_activities"],
    "fact_opportunities": lambda w: w.gold["fact_opportunities"],
    "fact_campaign_touches": lambda w: w.gold["fact_campaign_touches"],
    "lead_summary": lambda w: w.summary,
    "survival_input": lambda w: w.survival,
    "lead_summary_scored": lambda w: star.scored_summary(w.summary, w.rule_outputs),
    # constraints and quality
    "pk_violations": lambda w: quality.pk_violations({
        **w.raw, **w.clean, **w.gold, "dim_time": w.calendar, "ml_lead_scores": w.rule_outputs,
        "ml_survival_predictions": w.rule_medians, "ml_clv_predictions": w.values,
        "ml_uplift_predictions": w.uplift_rates}),
    "fk_violations": lambda w: quality.fk_violations(
        {**w.raw, **w.clean, **w.gold}, w.gold["dim_leads"], w.calendar),
    "required_values": lambda w: quality.required_values(w.clean),
    "text_lengths": lambda w: quality.text_lengths({**w.raw, **w.clean, "activities_rejected": w.rejected}, TEXT_LIMITS),
    "row_counts": lambda w: quality.row_counts(_layers(w)),
    "layer_totals": lambda w: quality.layer_totals(quality.row_counts(_layers(w))),
    "quality_checks": lambda w: quality.quality_checks(w.summary),
    "quality_issue_list": lambda w: quality.quality_issue_list(quality.quality_checks(w.summary)),
    # scoring
    "scoring_features": lambda w: w.features,
    "target_distribution": lambda w: scoring.target_distribution(w.features),
    "imputed_features": lambda w: scoring.impute_and_scale(w.features, scoring.NUMERIC_FEATURES),
    "class_weights": lambda w: scoring.class_weights(w.features),
    "confusion_metrics": lambda w: scoring.confusion_metrics(w.rule_scores, threshold=0.2),
    "risk_tiers": lambda w: w.rule_outputs.select("lead_id", "conversion_probability", "risk_tier"),
    "tier_thresholds": lambda w: scoring.tier_thresholds(w.rule_scores),
    "expected_loss": lambda w: w.rule_outputs.select("lead_id", "expected_loss"),
    "risk_tier_counts": lambda w: scoring.tier_counts(w.rule_outputs, "risk_tier", scoring.RISK_TIERS),
    "summary_report": lambda w: w.summary_report,
    "rule_auc": lambda w: scoring.mann_whitney(w.rule_scores),
    "rule_class_report": lambda w: scoring.class_report(scoring.confusion_metrics(w.rule_scores, threshold=0.2)),
    "logistic_coefficients": lambda w: logistic.coefficient_table(w.region_model, w.features),
    "logistic_scores": lambda w: w.features.select("lead_id", w.region_model.positive().alias("conversion_probability")),
    "scoring_metrics": lambda w: w.scoring_run.metrics,
    "class_report": lambda w: w.scoring_run.report,
    "lead_scores": lambda w: stamp(w.model_outputs, model_version=w.scoring_run.best_name),
    # survival
    "survival_cohort": lambda w: kaplan_meier.cohort(w.survival),
    "km_curve": lambda w: kaplan_meier.curve(w.survival, "lead_source"),
    "km_by_lead_source": lambda w: _km(w, "lead_source"),
    "km_by_industry": lambda w: _km(w, "industry"),
    "cox_design": lambda w: cox.design(w.survival, keep=["lead_id"]),
    "cox_hazard_ratios": lambda w: cox.hazard_ratios(w.survival, w.cox_model),
    "concordance": lambda w: w.concordance,
    "cox_concordance": lambda w: w.cox_concordance,
    "survival_predictions": lambda w: stamp(
        w.survival_predictions.select("lead_id", "predicted_median_days"), survival_model="CoxPH"),
    "rule_prediction_stats": lambda w: cox.prediction_stats(w.rule_times),
    "survival_prediction_stats": lambda w: cox.prediction_stats(w.survival_predictions),
    # customer value
    "deal_medians": lambda w: clv.deal_medians(w.summary),
    "clv": lambda w: w.values,
    "clv_summary": lambda w: clv.summary_stats(w.values),
    "clv_tier_counts": lambda w: scoring.tier_counts(w.values, "clv_tier", clv.VALUE_TIERS),
    "clv_predictions": lambda w: stamp(w.model_values, model_version="CLV v1 (survival-integrated)"),
    # uplift
    "campaign_cohort": lambda w: w.cohort,
    "arm_outcomes": lambda w: uplift.arm_outcomes(w.cohort),
    "arm_rates": lambda w: uplift.arm_rates(w.cohort),
    "uplift_stats": lambda w: uplift.uplift_stats(w.uplift_rates),
    "uplift_segments": lambda w: w.uplift_segments,
    "uplift_summary": lambda w: uplift.uplift_summary(w.uplift_segments),
    "qini_curve": lambda w: uplift.qini_curve(w.uplift_rates),
    "uplift_by_segment": lambda w: uplift.by_segment(w.uplift_segments),
    "uplift_with_value": lambda w: uplift.with_deal_value(w.uplift_segments, w.summary),
    "top_persuadable": lambda w: uplift.top_of_segment(
        uplift.with_deal_value(w.uplift_segments, w.summary), "Persuadable", 25, best_first=True),
    "top_do_not_disturb": lambda w: uplift.top_of_segment(
        uplift.with_deal_value(w.uplift_segments, w.summary), "Do Not Disturb", 15, best_first=False),
    "uplift_arm_metrics": lambda w: w.uplift_run.metrics,
    "uplift_scores": lambda w: stamp(w.model_uplift),
    "model_qini_curve": lambda w: uplift.qini_curve(w.model_uplift),
    # reports
    "lead_projection": lambda w: w.portfolio,
    "country_metrics": lambda w: w.countries,
    "lead_search": lambda w: reports.search(w.portfolio, "customer#0000000[1-3]|^l10[0-9]$").select(
        "lead_id", "company_name", "status"),
    "customer_kpis": lambda w: reports.customer_kpis(w.portfolio),
    "customer_portfolio": lambda w: reports.customer_portfolio(w.portfolio),
    "funnel": lambda w: reports.funnel(w.portfolio),
    "funnel_exits": lambda w: reports.funnel_exits(w.portfolio),
    "customer_360": lambda w: reports.customer_360(w.portfolio, "L7"),
    "pct_rank": _ranks,
    "proxy_risk": lambda w: w.risks,
    "risk_kpis": lambda w: reports.risk_kpis(reports.keep_selected(
        w.risks, {"region": ["ASIA", "EUROPE"], "industry": [], "risk_tier": ["Low", "Medium"]})),
    "risk_histogram": lambda w: reports.histogram(w.risks, "risk_score", 25),
    "score_histogram": lambda w: reports.histogram(w.rule_outputs, "conversion_probability", 40, "risk_tier"),
    "clv_histogram": lambda w: reports.histogram(w.values.filter("clv_discounted > 0"), "clv_discounted", 60, "clv_tier"),
    "uplift_histogram": lambda w: reports.histogram(w.uplift_segments, "uplift", 60, "uplift_segment"),
    "risk_tier_breakdown": lambda w: scoring.tier_counts(w.risks, "risk_tier", scoring.RISK_TIERS),
    "uplift_segment_counts": lambda w: scoring.tier_counts(w.uplift_segments, "uplift_segment", uplift.SEGMENTS),
    "risk_by_industry": lambda w: reports.mean_by(w.risks, "industry", "risk_score", "avg_risk", 8),
    "loss_by_region": lambda w: reports.sum_by(w.risks, "region", "expected_loss"),
    "top_risk": lambda w: reports.top(w.risks, "risk_score", 15, RISK_COLUMNS),
    "intervention_summary": lambda w: reports.intervention_summary(w.portfolio),
    "intervention_effect": lambda w: reports.intervention_effect(reports.intervention_summary(w.portfolio)),
    "response_by_arm": lambda w: reports.response_by_arm(w.portfolio),
    "uplift_by_source": lambda w: reports.uplift_by_source(w.portfolio),
    "best_source_uplift": lambda w: reports.best_source_uplift(reports.uplift_by_source(w.portfolio)),
    "scored_leads": _scored,
    "score_kpis": lambda w: reports.score_kpis(_scored(w)),
    "calibration": lambda w: scoring.calibration(_scored(w)),
    "top_leads": lambda w: reports.top(_scored(w), "conversion_probability", 25, TOP_LEAD_COLUMNS),
    "model_comparison": lambda w: lead_models.model_comparison(w.scoring_run.metrics),
    "km_report": lambda w: kaplan_meier.report(_km(w, "lead_source")),
    "cox_report": lambda w: cox.report(cox.hazard_ratios(w.survival, w.cox_model)),
    "rule_fastest_leads": lambda w: reports.fastest_leads(w.rule_times, w.summary),
    "rule_prediction_histogram": lambda w: reports.histogram(w.rule_times, "predicted_median_days", 50, "lead_source"),
    "fastest_leads": lambda w: reports.fastest_leads(w.survival_predictions, w.summary),
    "prediction_histogram": lambda w: reports.histogram(
        w.survival_predictions.join(w.summary.select("lead_id", "lead_source"), "lead_id", "left"),
        "predicted_median_days", 50, "lead_source"),
    "clv_detail": lambda w: w.value_detail,
    "clv_quadrant": lambda w: reports.clv_quadrant(w.values, w.parameters.quadrant_min_leads),
    "top_clv": lambda w: reports.top(w.value_detail, "clv_discounted", 25, TOP_VALUE_COLUMNS),
    "clv_by_industry": lambda w: reports.clv_by(w.values, "industry"),
    "clv_by_source": lambda w: reports.clv_by(w.values, "lead_source"),
    "best_clv_segments": lambda w: reports.best_clv_segments(w.values),
    "map_kpis": lambda w: reports.map_kpis(w.countries),
    "top_countries": lambda w: reports.top_countries(w.countries, "Leads"),
    "top_countries_by_rate": lambda w: reports.top_countries(w.countries, "Conversion Rate"),
    "top_countries_by_value": lambda w: reports.top_countries(w.countries, "CLV"),
    "top_countries_by_risk": lambda w: reports.top_countries(w.countries, "Risk"),
    "region_rollup": lambda w: reports.region_rollup(w.countries),
    "country_drilldown": lambda w: reports.country_drilldown(w.countries, "NATION_3"),
    "dashboard_kpis": lambda w: reports.dashboard_kpis(w.risks, quality.quality_checks(w.summary)),
    "conversion_by_source": lambda w: reports.conversion_by(w.portfolio, "lead_source"),
    "overview_kpis": lambda w: reports.overview_kpis(w.portfolio),
    "monthly_trend": lambda w: reports.monthly_trend(w.portfolio),
    "status_distribution": lambda w: reports.count_by(w.portfolio, "status"),
    "top_industries": lambda w: reports.count_by(w.portfolio, "industry", 5),
    "value_by_region": lambda w: reports.mean_by(w.portfolio, "region", "deal_value", "avg_value"),
    "recent_customers": lambda w: reports.recent_customers(w.portfolio),
    "filter_values": lambda w: reports.filter_values(w.portfolio, FILTER_COLUMNS),
    "conversion_profile": lambda w: reports.conversion_profile(w.summary),
}
