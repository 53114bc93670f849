"""Calendar, dimensions, facts, the one-row-per-lead summary and the survival input."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealgauge.operators.cleaning import LEAD_COLUMNS


def with_date_parts(days: DataFrame) -> DataFrame:
    """Calendar attributes of ``date_id``; names are blank-padded to nine, Sunday is day 0."""
    d = F.col("date_id")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.rpad(F.date_format(d, "EEEE"), 9, " ").alias("day_name"),
        (F.dayofweek(d) - 1).isin(0, 6).alias("is_weekend"),
    )


def day_series(bounds: DataFrame, start: str = "first_day", end: str = "last_day") -> DataFrame:
    """Every day from start to end, both included, for a one-row frame of bounds."""
    days = F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("date_id"))


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return with_date_parts(day_series(bounds))


def covering_calendar(dated: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Calendar of the whole years that hold every date in the given columns."""
    spans = [
        rows.agg(
            F.min(F.least(*columns) if len(columns) > 1 else F.col(columns[0])).alias("low"),
            F.max(F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])).alias("high"),
        )
        for rows, columns in dated
    ]
    span = reduce(DataFrame.unionByName, spans).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return with_date_parts(day_series(span.select(
        F.trunc("low", "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc("high", "year"), 12), 1).alias("last_day"),
    )))


def dim_leads(leads: DataFrame) -> DataFrame:
    return leads.select(LEAD_COLUMNS)


def fact_activities(activities: DataFrame) -> DataFrame:
    return activities.select(
        "activity_id", "lead_id", F.col("activity_date").alias("date_id"), "activity_type", "channel", "outcome")


def fact_opportunities(opportunities: DataFrame) -> DataFrame:
    return opportunities.select(
        "opportunity_id", "lead_id", "deal_value", "deal_value_outlier", "stage", "owner",
        F.col("open_date").alias("open_date_id"),
        F.col("expected_close_date").alias("expected_close_date_id"),
        F.col("actual_close_date").alias("actual_close_date_id"),
    )


def fact_campaign_touches(touches: DataFrame) -> DataFrame:
    return touches.select(
        "touch_id", "lead_id", "campaign_id", F.col("touch_date").alias("date_id"), "response", "treatment_group")


def activity_stats(activities: DataFrame) -> DataFrame:
    return activities.groupBy("lead_id").agg(
        F.count(F.lit(1)).alias("total_activities"),
        F.min("activity_date").alias("first_activity_date"),
        F.max("activity_date").alias("last_activity_date"),
    )


def _duration(snapshot: dt.date) -> Column:
    closed = (F.col("status") == "Converted") & F.col("actual_close_date").isNotNull()
    return F.when(closed, F.datediff("actual_close_date", "created_date")).otherwise(
        F.datediff(F.lit(snapshot), "created_date"))


def lead_summary(
    leads: DataFrame, activities: DataFrame, opportunities: DataFrame, touches: DataFrame, snapshot: dt.date,
) -> DataFrame:
    """One row per lead. All joins are on lead_id, so the lead side is shuffled once at most, and
    the activities are counted per lead before they are joined."""
    stats = activity_stats(activities)
    opp = opportunities.select(
        "lead_id", F.lit(True).alias("opp_match"), "opportunity_id",
        F.col("stage").alias("opportunity_stage"), "deal_value", "deal_value_outlier",
        "open_date", "expected_close_date", "actual_close_date",
    )
    touch = touches.select(
        "lead_id", F.lit(True).alias("touch_match"), F.col("touch_date").alias("campaign_touch_date"),
        F.col("response").alias("campaign_response"), "treatment_group",
    )
    joined = leads.join(stats, "lead_id", "left").join(opp, "lead_id", "left").join(touch, "lead_id", "left")
    return joined.select(
        *LEAD_COLUMNS,
        F.coalesce("total_activities", F.lit(0)).alias("total_activities"),
        "first_activity_date", "last_activity_date",
        F.col("touch_match").isNotNull().alias("received_campaign"),
        "campaign_touch_date", "campaign_response", "treatment_group",
        F.col("opp_match").isNotNull().alias("has_opportunity"),
        "opportunity_id", "opportunity_stage", "deal_value", "deal_value_outlier",
        "open_date", "expected_close_date", "actual_close_date",
        F.when(F.col("status") == "Converted", 1).otherwise(0).alias("event_converted"),
        _duration(snapshot).alias("duration_days"),
    )


def survival_input(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("duration_days") > 0).select(
        "lead_id",
        F.col("duration_days").cast("double").alias("duration_days"),
        F.col("event_converted").cast("int").alias("event_converted"),
        "industry", "lead_source", "region", "job_title",
        F.col("company_size").cast("double").alias("company_size"),
        F.col("total_activities").cast("int").alias("total_activities"),
        F.coalesce(F.col("received_campaign"), F.lit(False)).cast("int").alias("received_campaign"),
    )


def scored_summary(summary: DataFrame, scores: DataFrame) -> DataFrame:
    columns = ["lead_id", "conversion_probability", "risk_tier", "expected_loss"]
    return summary.join(scores.select(columns), "lead_id", "left")
