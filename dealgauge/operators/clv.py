"""Discounted customer value from probability, deal value and time to conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealgauge.operators.ranks import quantiles
from dealgauge.sources.stages import measured

DISCOUNT_RATE = 0.10
FALLBACK_YEARS = 5.0
VALUE_TIERS = ["High", "Medium", "Low", "Unscored"]


def deal_medians(summary: DataFrame) -> DataFrame:
    """Median of the positive deals per industry."""
    return quantiles(summary.filter("deal_value > 0"), "deal_value", {"segment_median": 0.5}, by=["industry"])


def global_deal_median(summary: DataFrame) -> DataFrame:
    return quantiles(summary.filter("deal_value > 0"), "deal_value", {"global_median": 0.5})


def lifetime_values(
    summary: DataFrame, scores: DataFrame, medians: DataFrame,
    rate: float = DISCOUNT_RATE, fallback_years: float = FALLBACK_YEARS,
) -> DataFrame:
    """One row per lead. The three inputs are joined on lead_id, the industry medians by size."""
    base_rate = scores.join(summary.select("lead_id"), "lead_id", "left_semi").agg(
        F.avg("conversion_probability").alias("m")).scalar()
    joined = (
        summary.select("lead_id", "industry", "lead_source", "region", "deal_value")
        .join(scores.select("lead_id", "conversion_probability"), "lead_id", "left")
        .join(medians.select("lead_id", "predicted_median_days"), "lead_id", "left")
        .join(measured(deal_medians(summary)), "industry", "left")
    )
    positive = F.col("deal_value") > 0
    segment_deal = F.coalesce("segment_median", global_deal_median(summary).scalar())
    years = F.col("predicted_median_days") / 365.25
    valued = joined.select(
        "lead_id", "industry", "lead_source", "region",
        F.coalesce("conversion_probability", base_rate).alias("conversion_probability"),
        F.when(positive, F.col("deal_value")).otherwise(segment_deal).alias("effective_deal_value"),
        (~F.coalesce(positive, F.lit(False))).alias("used_imputed_deal"),
        F.when(years > 0, years).otherwise(F.lit(fallback_years)).alias("median_years"),
    ).withColumn("discount_factor", F.exp(-F.lit(rate) * F.col("median_years")))
    undiscounted = F.col("conversion_probability") * F.col("effective_deal_value")
    return valued.withColumn("clv_undiscounted", undiscounted).withColumn(
        "clv_discounted", undiscounted * F.col("discount_factor")).withColumn("discount_rate", F.lit(rate))


def with_value_tier(values: DataFrame) -> DataFrame:
    """Best fifth "High", the next three tenths "Medium", the rest "Low", no value "Unscored"."""
    cuts = quantiles(values, "clv_discounted", {"q50": 0.5, "q80": 0.8})
    v = F.col("clv_discounted")
    tier = (
        F.when(v.isNull(), "Unscored").when(v >= cuts.select("q80").scalar(), "High")
        .when(v >= cuts.select("q50").scalar(), "Medium").otherwise("Low")
    )
    return values.withColumn("clv_tier", tier)


def summary_stats(values: DataFrame) -> DataFrame:
    cuts = quantiles(values, "clv_discounted", {"q50": 0.5, "q80": 0.8, "q90": 0.9})
    return values.agg(
        F.count(F.lit(1)).alias("total_leads"),
        F.count("conversion_probability").alias("leads_with_probability"),
        F.count_if("used_imputed_deal").alias("imputed_deals"),
        F.sum("clv_discounted").alias("total_clv"),
        F.avg("clv_discounted").alias("mean_clv"),
        F.max("clv_discounted").alias("max_clv"),
    ).select(
        "*",
        cuts.select("q50").scalar().alias("median_clv"),
        cuts.select("q80").scalar().alias("q80_clv"),
        cuts.select("q90").scalar().alias("p90_clv"),
    )
