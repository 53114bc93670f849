"""All tables of one input folder: raw, cleaned, star schema, predictions.

Frames are lazy. Tables that many queries share are written stages (see StageStore): the lead
summary, the scores and values, and everything that comes out of a model fit.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealgauge.fixtures.order_book import OrderBook
from dealgauge.operators import cleaning, clv, concordance, cox, kaplan_meier, lead_models, logistic, scoring, star, uplift
from dealgauge.operators.lead_models import ModelSettings
from dealgauge.plans import reports
from dealgauge.session import shared_dir
from dealgauge.sources.files import read_raw_csv, read_summary, write_summary
from dealgauge.sources.stages import StageStore, measured


@dataclass(frozen=True)
class Parameters:
    """Settings of a deployment; the defaults are the documented ones."""

    snapshot: dt.date = dt.date(2026, 9, 6)
    calendar_first: dt.date = dt.date(2010, 1, 1)
    calendar_last: dt.date = dt.date(2026, 12, 31)
    quadrant_min_leads: int = 100
    largest_sources: int = 6
    largest_industries: int = 7
    rows_per_bucket: int = 2_000_000
    models: ModelSettings = ModelSettings()


GIVEN_TABLES = Parameters(
    snapshot=dt.date(2002, 1, 1), calendar_first=dt.date(1994, 1, 1), calendar_last=dt.date(2024, 12, 31),
    quadrant_min_leads=20)


class Workspace:
    def __init__(self, spark: SparkSession, folder: str, parameters: Parameters = GIVEN_TABLES):
        self.spark = spark
        self.parameters = parameters
        book = OrderBook(spark, folder)
        # Lead-grain stages share one bucketing, so that joins on lead_id are co-located. Small
        # inputs are not bucketed: Catalyst broadcasts one side anyway. With fewer buckets than
        # shuffle partitions Catalyst would shuffle both sides again for parallelism.
        buckets = book.lead_count() // parameters.rows_per_bucket
        if buckets:
            buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.stages = StageStore(spark, f"{folder}|{parameters}", buckets)
        self.raw = {
            "raw_leads": book.raw_leads(), "raw_opportunities": book.raw_opportunities(),
            "raw_activities": book.raw_activities(), "raw_campaign_touches": book.raw_campaign_touches(),
        }

    @cached_property
    def csv_activities(self) -> DataFrame:
        """The raw activities through CSV: written in read order as several files, read and numbered again."""
        def build() -> DataFrame:
            path = f"{shared_dir(self.spark)}/csv/{uuid.uuid4().hex}"
            self.raw["raw_activities"].repartitionByRange(7, "ingest_seq").sortWithinPartitions("ingest_seq").drop("ingest_seq").write.csv(
                path, header=True, escape='"')
            return read_raw_csv(self.spark, path, "raw_activities", multi_line=False)
        return self.stages.table("csv_activities", build)

    # ---- cleaned tables -------------------------------------------------------------------

    # Each cleaned table is the last step of its job, so an orphan id that holds a large part of
    # the rows can be split at run time, and the later joins on lead_id see known leads only.

    @cached_property
    def leads(self) -> DataFrame:
        return self.stages.table("leads_clean", lambda: cleaning.clean_leads(self.raw["raw_leads"]), key="lead_id")

    @cached_property
    def opportunities(self) -> DataFrame:
        return self.stages.table(
            "opportunities_clean", lambda: cleaning.clean_opportunities(self.raw["raw_opportunities"], self.leads), key="lead_id")

    @cached_property
    def touches(self) -> DataFrame:
        return self.stages.table(
            "campaign_touches_clean", lambda: cleaning.clean_touches(self.raw["raw_campaign_touches"], self.leads), key="lead_id")

    @cached_property
    def checked_activities(self) -> DataFrame:
        return self.stages.table(
            "activities_checked", lambda: cleaning.check_activities(self.raw["raw_activities"], self.leads),
            partition_by=["rejection_reason"])

    @cached_property
    def activities(self) -> DataFrame:
        return self.checked_activities.filter("rejection_reason is null").select(cleaning.ACTIVITY_COLUMNS)

    @cached_property
    def rejected(self) -> DataFrame:
        return self.checked_activities.filter("rejection_reason is not null")

    @cached_property
    def clean(self) -> dict[str, DataFrame]:
        return {
            "leads_clean": self.leads, "opportunities_clean": self.opportunities,
            "activities_clean": self.activities, "campaign_touches_clean": self.touches,
        }

    # ---- star schema ----------------------------------------------------------------------

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return {
            "dim_leads": star.dim_leads(self.leads),
            "fact_opportunities": star.fact_opportunities(self.clean["opportunities_clean"]),
            "fact_activities": star.fact_activities(self.clean["activities_clean"]),
            "fact_campaign_touches": star.fact_campaign_touches(self.clean["campaign_touches_clean"]),
            "lead_summary": self.summary,
        }

    @cached_property
    def calendar(self) -> DataFrame:
        return star.calendar(self.spark, self.parameters.calendar_first, self.parameters.calendar_last)

    @cached_property
    def covering_calendar(self) -> DataFrame:
        return star.covering_calendar([
            (self.raw["raw_leads"], ["created_date"]),
            (self.raw["raw_opportunities"], ["open_date", "expected_close_date", "actual_close_date"]),
            (self.raw["raw_activities"], ["activity_date"]),
            (self.raw["raw_campaign_touches"], ["touch_date"]),
        ])

    @cached_property
    def summary(self) -> DataFrame:
        return self.stages.table("lead_summary", lambda: star.lead_summary(
            self.leads, self.activities, self.opportunities, self.touches, self.parameters.snapshot), key="lead_id")

    @cached_property
    def portfolio(self) -> DataFrame:
        return reports.portfolio(self.summary)

    @cached_property
    def survival(self) -> DataFrame:
        return star.survival_input(self.summary)

    @cached_property
    def risks(self) -> DataFrame:
        return self.stages.table("proxy_risk", lambda: reports.proxy_risk(self.portfolio), key="lead_id")

    # ---- predictions that plain SQL can follow --------------------------------------------

    @cached_property
    def features(self) -> DataFrame:
        return scoring.select_features(self.summary)

    @cached_property
    def rule_scores(self) -> DataFrame:
        return self.stages.table("rule_scores", lambda: scoring.rule_scores(self.summary), key="lead_id")

    @cached_property
    def rule_outputs(self) -> DataFrame:
        return self.stages.table("rule_outputs", lambda: scoring.business_outputs(self.rule_scores), key="lead_id")

    @cached_property
    def rule_medians(self) -> DataFrame:
        """Survival median of the lead's source in place of a model prediction."""
        medians = kaplan_meier.by_segment(self.survival, "lead_source", self.parameters.largest_sources)
        return self.survival.select("lead_id", "lead_source").join(
            measured(medians.select("lead_source", F.col("median_days").alias("predicted_median_days"))),
            "lead_source", "left")

    @cached_property
    def rule_times(self) -> DataFrame:
        """Predicted days to conversion by a rule that gives every lead a value."""
        return self.stages.table("rule_times", lambda: kaplan_meier.constant_hazard_medians(self.survival, ["lead_source", "industry"]))

    @cached_property
    def values(self) -> DataFrame:
        priced = self.stages.table(
            "clv_values", lambda: clv.lifetime_values(self.summary, self.rule_outputs, self.rule_medians), key="lead_id")
        return clv.with_value_tier(priced)

    @cached_property
    def value_detail(self) -> DataFrame:
        return reports.clv_detail(self.values, self.rule_outputs, self.summary)

    @cached_property
    def cohort(self) -> DataFrame:
        return uplift.campaign_cohort(self.summary)

    @cached_property
    def uplift_rates(self) -> DataFrame:
        return self.stages.table("uplift_rates", lambda: uplift.segment_rate_scores(self.cohort), key="lead_id")

    @cached_property
    def uplift_segments(self) -> DataFrame:
        return uplift.with_segment(self.uplift_rates)

    @cached_property
    def countries(self) -> DataFrame:
        return self.stages.table(
            "country_metrics", lambda: reports.country_metrics(self.summary, self.rule_outputs, self.values))

    @cached_property
    def concordance(self) -> DataFrame:
        scored = self.survival.join(self.rule_scores.select("lead_id", "conversion_probability"), "lead_id")
        return concordance.concordance_index(
            concordance.concordance_pairs(scored, "conversion_probability"))

    @cached_property
    def summary_report(self) -> DataFrame:
        """Summaries of the rule-based outputs, written as JSON and read back for one report."""
        thresholds = scoring.tier_thresholds(self.rule_scores).unpivot([], ["q20", "q80"], "quantile", "score")
        summaries = {
            "risk_tier_counts": (scoring.tier_counts(self.rule_outputs, "risk_tier", scoring.RISK_TIERS), "risk_tier", "leads"),
            "risk_tier_thresholds": (thresholds, "quantile", "score"),
            "class_report": (scoring.class_report(scoring.confusion_metrics(self.rule_scores, threshold=0.2)), "line", "f1"),
            "clv_tier_counts": (scoring.tier_counts(self.values, "clv_tier", clv.VALUE_TIERS), "clv_tier", "leads"),
            "uplift_segment_counts": (
                scoring.tier_counts(self.uplift_segments, "uplift_segment", uplift.SEGMENTS), "uplift_segment", "leads"),
        }

        def build() -> DataFrame:
            root, read = f"{shared_dir(self.spark)}/summaries/{uuid.uuid4().hex}", {}
            for name, (rows, label, value) in summaries.items():
                write_summary(rows, f"{root}/{name}")
                read[name] = (read_summary(self.spark, f"{root}/{name}"), label, value)
            return reports.summary_lines(read)
        return self.stages.table("summary_report", build)

    # ---- fitted models --------------------------------------------------------------------

    @cached_property
    def scoring_run(self) -> lead_models.ScoringRun:
        written = self.stages.table("scoring_features", lambda: self.features)
        return lead_models.train_scoring(written, self.parameters.models)

    @cached_property
    def region_model(self) -> logistic.LogisticModel:
        """A logistic model small enough for a twin in SQL: the numbers and the region."""
        written = self.stages.table("scoring_features", lambda: self.features)
        return logistic.fit_logistic(written, scoring.NUMERIC_FEATURES, ["region"], scoring.TARGET)

    @cached_property
    def model_scores(self) -> DataFrame:
        def build() -> DataFrame:
            return lead_models.score_all(self.scoring_run.best_model, self.features)
        return self.stages.table("model_scores", build, key="lead_id")

    @cached_property
    def model_outputs(self) -> DataFrame:
        return self.stages.table("model_outputs", lambda: scoring.business_outputs(self.model_scores), key="lead_id")

    @cached_property
    def cox_model(self) -> cox.CoxModel:
        return cox.fit(self.stages.table("survival_input", lambda: self.survival))

    @cached_property
    def survival_predictions(self) -> DataFrame:
        return self.stages.table(
            "survival_predictions", lambda: cox.predicted_medians(self.survival, self.cox_model), key="lead_id")

    @cached_property
    def cox_concordance(self) -> DataFrame:
        scored = self.survival.join(self.survival_predictions.select("lead_id", "log_hazard"), "lead_id")
        return concordance.concordance_index(concordance.concordance_pairs(scored, "log_hazard"))

    @cached_property
    def model_values(self) -> DataFrame:
        priced = self.stages.table("model_clv_values", lambda: clv.lifetime_values(
            self.summary, self.model_outputs, self.survival_predictions), key="lead_id")
        return clv.with_value_tier(priced)

    @cached_property
    def uplift_run(self) -> lead_models.UpliftRun:
        written = self.stages.table("campaign_cohort", lambda: self.cohort)
        return lead_models.train_two_arms(written, self.parameters.models)

    @cached_property
    def model_uplift(self) -> DataFrame:
        scored = self.stages.table(
            "model_uplift", lambda: lead_models.score_two_arms(self.uplift_run, self.cohort), key="lead_id")
        return uplift.with_segment(scored)


_open: dict[tuple[str, str, Parameters], Workspace] = {}


def workspace(spark: SparkSession, folder: str, parameters: Parameters = GIVEN_TABLES) -> Workspace:
    """The workspace of a folder, shared by all queries of one application."""
    key = (spark.sparkContext.applicationId, folder, parameters)
    if key not in _open:
        _open[key] = Workspace(spark, folder, parameters)
    return _open[key]
