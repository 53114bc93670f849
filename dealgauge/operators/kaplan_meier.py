"""Survival cohort, Kaplan-Meier curves and medians per segment."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealgauge.sources.stages import measured


def cohort(rows: DataFrame) -> DataFrame:
    """Size, events, event rate and median duration. Durations are whole days: few distinct values."""
    return rows.agg(
        F.count(F.lit(1)).alias("leads"),
        F.sum("event_converted").alias("events"),
        F.avg("event_converted").alias("event_rate"),
        F.percentile("duration_days", 0.5).alias("median_duration"),
    )


def largest_segments(rows: DataFrame, segment: str, n: int) -> DataFrame:
    return (
        rows.filter(F.col(segment).isNotNull()).groupBy(segment).agg(F.count(F.lit(1)).alias("size"))
        .orderBy(F.desc("size"), segment).limit(n)
    )


def curve(rows: DataFrame, segment: str) -> DataFrame:
    """Survival after each observed day: the product of 1 - deaths / at risk.

    Rows are first counted per segment and day; the windows see one row per distinct day.
    """
    days = rows.filter(F.col(segment).isNotNull()).groupBy(segment, "duration_days").agg(
        F.sum("event_converted").alias("deaths"), F.count(F.lit(1)).alias("leaving"))
    later = Window.partitionBy(segment).orderBy(F.desc("duration_days")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(segment).orderBy("duration_days").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("at_risk", F.sum("leaving").over(later)).withColumn(
        "survival", F.product(1 - F.col("deaths") / F.col("at_risk")).over(earlier))


def medians(curves: DataFrame, segment: str) -> DataFrame:
    """First day with survival at or below one half (null if never), size and events."""
    return curves.groupBy(segment).agg(
        F.min(F.when(F.col("survival") <= 0.5, F.col("duration_days"))).alias("median_days"),
        F.sum("leaving").alias("n"),
        F.sum("deaths").alias("events"),
    )


def constant_hazard_medians(rows: DataFrame, segments: list[str]) -> DataFrame:
    """Median of each lead under its segment's constant hazard, ln 2 * days at risk / events; null without events.

    Unlike the Kaplan-Meier median it is there for segments of which less than half have converted."""
    days, events = F.sum("duration_days"), F.sum("event_converted")
    rates = measured(rows.groupBy(*segments).agg(
        F.round(F.when(events > 0, math.log(2) * days / events), 6).alias("predicted_median_days")))
    same = [rows[c].eqNullSafe(rates[c]) for c in segments]
    return rows.join(rates, same).select(rows["lead_id"], *[rows[c] for c in segments], "predicted_median_days")


def by_segment(rows: DataFrame, segment: str, n: int) -> DataFrame:
    """Medians of the n largest segments. The curve has one row per segment and day: filter that."""
    largest = largest_segments(rows, segment, n).select(segment)
    return medians(curve(rows, segment).join(largest, segment, "left_semi"), segment)


def report(segment_medians: DataFrame) -> DataFrame:
    """Event rate, median in years and whether the median was reached."""
    return segment_medians.withColumn(
        "conversion_rate", F.coalesce(F.try_divide("events", "n"), F.lit(0.0))
    ).withColumn("median_years", F.col("median_days") / 365.25).withColumn(
        "reached", F.col("median_days").isNotNull()).orderBy(F.col("median_days").asc_nulls_last())
