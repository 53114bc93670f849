"""The whole workload, stage by stage: raw, cleaned, star schema, scores, survival, value, uplift.

Every stage reads written tables and writes its own, so a stage can be run again by itself and a
second run leaves the same tables. The tables of a stage become visible together when all are written; a stage
that fails leaves the ones before. ``target`` is a folder that all executors can reach.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from dealgauge.operators import cleaning, clv, concordance, cox, kaplan_meier, lead_models, scoring, star, uplift
from dealgauge.plans.workspace import Parameters
from dealgauge.sources.files import PUBLISHED_TABLES, load_raw_folder, publish, read_summary, stamp, write_summary
from dealgauge.sources.versions import TableSet

CHECKED = "activities_checked"


class Pipeline:
    def __init__(self, spark: SparkSession, target: str, parameters: Parameters = Parameters()):
        self.spark = spark
        self.target = target.rstrip("/")
        self.parameters = parameters
        self.tables = TableSet(spark, self.target)

    def table(self, name: str) -> DataFrame:
        """A written table. Valid and rejected activities are two partitions of one folder."""
        if name == "activities_rejected":
            return self.tables.table(CHECKED).filter("rejection_reason is not null")
        if name == "activities_clean":
            return self.tables.table(CHECKED).filter("rejection_reason is null").select(cleaning.ACTIVITY_COLUMNS)
        return self.tables.table(name)

    def _write(self, name: str, rows: DataFrame) -> None:
        with self.tables.reload() as batch:
            batch.write(name, rows)

    def _summarise(self, name: str, rows: DataFrame) -> None:
        write_summary(rows, f"{self.target}/summaries/{name}")

    def summary(self, name: str) -> DataFrame:
        """A summary that an earlier stage, or an earlier run, has written."""
        return read_summary(self.spark, f"{self.target}/summaries/{name}")

    def _save_model(self, name: str, model: PipelineModel) -> None:
        lead_models.save_model(model, f"{self.target}/models/{name.lower().replace(' ', '_')}")

    def load_bronze(self, raw: str | Mapping[str, DataFrame]) -> None:
        """From a folder of CSV files, or from frames with the raw schemas."""
        if isinstance(raw, str):
            load_raw_folder(self.spark, raw, self.tables)
            return
        with self.tables.reload() as batch:
            for name, rows in raw.items():
                batch.write(name, rows)

    def clean_to_silver(self) -> None:
        with self.tables.reload() as batch:
            leads = batch.write("leads_clean", cleaning.clean_leads(batch.table("raw_leads")))
            batch.write("opportunities_clean", cleaning.clean_opportunities(batch.table("raw_opportunities"), leads))
            batch.write("campaign_touches_clean", cleaning.clean_touches(batch.table("raw_campaign_touches"), leads))
            batch.write(CHECKED, cleaning.check_activities(batch.table("raw_activities"), leads), ["rejection_reason"])

    def build_gold(self) -> None:
        p = self.parameters
        leads, opportunities = self.table("leads_clean"), self.table("opportunities_clean")
        activities, touches = self.table("activities_clean"), self.table("campaign_touches_clean")
        with self.tables.reload() as batch:
            batch.write("dim_time", star.calendar(self.spark, p.calendar_first, p.calendar_last))
            batch.write("dim_leads", star.dim_leads(leads))
            batch.write("fact_activities", star.fact_activities(activities))
            batch.write("fact_opportunities", star.fact_opportunities(opportunities))
            batch.write("fact_campaign_touches", star.fact_campaign_touches(touches))
            batch.write("lead_summary", star.lead_summary(leads, activities, opportunities, touches, p.snapshot))

    def survival_view(self) -> DataFrame:
        view = star.survival_input(self.table("lead_summary"))
        view.createOrReplaceTempView("vw_survival_input")
        return view

    def train_ml_models(self) -> None:
        self._write("scoring_features", scoring.select_features(self.table("lead_summary")))
        features = self.table("scoring_features")
        run = lead_models.train_scoring(features, self.parameters.models)
        self._write("model_scores", lead_models.score_all(run.best_model, features))
        outputs = scoring.business_outputs(self.table("model_scores"))
        self._write("ml_lead_scores", stamp(outputs, model_version=run.best_name))
        self._save_model(run.best_name, run.best_model)
        self._summarise("model_metrics", run.metrics)
        self._summarise("model_class_report", run.report)
        self._summarise("model_features", self.spark.createDataFrame(
            [(c, kind) for kind, names in (("number", scoring.NUMERIC_FEATURES), ("category", scoring.CATEGORICAL_FEATURES)) for c in names],
            "feature string, kind string"))
        self._summarise("target_distribution", scoring.target_distribution(features))
        self._summarise("risk_tier_thresholds", scoring.tier_thresholds(self.table("model_scores")))
        self._summarise("risk_tier_counts", scoring.tier_counts(outputs, "risk_tier", scoring.RISK_TIERS))
        scored = star.scored_summary(self.table("lead_summary"), self.table("ml_lead_scores"))
        scored.createOrReplaceTempView("vw_lead_summary_scored")

    def survival_analysis(self) -> None:
        self._write("survival_rows", self.survival_view())
        rows = self.table("survival_rows")
        for segment, n in (
            ("lead_source", self.parameters.largest_sources), ("industry", self.parameters.largest_industries)
        ):
            self._summarise(f"survival_km_by_{segment}", kaplan_meier.by_segment(rows, segment, n))
        model = cox.fit(rows)
        predicted = cox.predicted_medians(rows, model)
        self._write("survival_scores", predicted)
        self._write("ml_survival_predictions", stamp(
            self.table("survival_scores").select("lead_id", "predicted_median_days"), survival_model="CoxPH"))
        self._summarise("survival_cox", cox.hazard_ratios(rows, model))
        self._summarise("survival_cohort", kaplan_meier.cohort(rows))
        self._summarise("survival_prediction_stats", cox.prediction_stats(self.table("survival_scores")))
        cox.save_model(self.spark, model, f"{self.target}/models/cox")
        scored = rows.join(self.table("survival_scores").select("lead_id", "log_hazard"), "lead_id")
        self._summarise("survival_concordance", concordance.concordance_index(
            concordance.concordance_pairs(scored, "log_hazard")))

    def clv_modeling(self) -> None:
        priced = clv.lifetime_values(
            self.table("lead_summary"), self.table("ml_lead_scores"), self.table("ml_survival_predictions"))
        self._write("clv_values", priced)
        values = clv.with_value_tier(self.table("clv_values"))
        self._write("ml_clv_predictions", stamp(
            values.drop("used_imputed_deal"), model_version="CLV v1 (survival-integrated)"))
        self._summarise("clv_summary", clv.summary_stats(self.table("clv_values")))
        self._summarise("clv_tier_counts", scoring.tier_counts(values, "clv_tier", clv.VALUE_TIERS))

    def uplift_modeling(self) -> None:
        self._write("campaign_cohort", uplift.campaign_cohort(self.table("lead_summary")))
        cohort = self.table("campaign_cohort")
        run = lead_models.train_two_arms(cohort, self.parameters.models)
        self._write("uplift_scores", lead_models.score_two_arms(run, cohort))
        segmented = uplift.with_segment(self.table("uplift_scores"))
        self._write("ml_uplift_predictions", stamp(segmented))
        for arm, model in run.arms.items():
            self._save_model(f"uplift {arm}", model)
        self._summarise("uplift_arms", run.metrics)
        self._summarise("uplift_summary", uplift.uplift_summary(segmented))
        self._summarise("uplift_stats", uplift.uplift_stats(self.table("uplift_scores")))
        self._summarise("uplift_segment_counts", scoring.tier_counts(segmented, "uplift_segment", uplift.SEGMENTS))

    def run(self, raw: str | Mapping[str, DataFrame]) -> dict[str, float]:
        """All stages; returns the seconds of each.

        The three model stages need only the lead summary, so they share the cluster.
        """
        seconds: dict[str, float] = {}

        def timed(stage: str, *arguments: object) -> None:
            started = time.perf_counter()
            getattr(self, stage)(*arguments)
            seconds[stage] = round(time.perf_counter() - started, 3)

        timed("load_bronze", raw)
        for stage in ("clean_to_silver", "build_gold"):
            timed(stage)
        lead_models.fit_together(self.spark, [
            lambda stage=stage: timed(stage) for stage in ("train_ml_models", "survival_analysis", "uplift_modeling")])
        timed("clv_modeling")
        return seconds

    def publish(self, destination: str, fmt: str = "parquet", **options: str) -> list[str]:
        """Drop and replace the published tables at the destination, in their fixed order."""
        return publish({name: self.table(name) for name in PUBLISHED_TABLES}, destination, fmt, **options)
