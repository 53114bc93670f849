"""Scores to tiers, losses and counts; classification metrics; the group-rate rule score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealgauge.functions import nullable_div, right_closed_bins
from dealgauge.operators.ranks import quantiles, running_total
from dealgauge.sources.stages import measured

NUMERIC_FEATURES = ["total_activities", "company_size", "received_campaign"]
CATEGORICAL_FEATURES = ["industry", "lead_source", "region", "job_title", "treatment_group", "campaign_response"]
TARGET = "event_converted"
RISK_TIERS = ["Low", "Medium", "High"]


def select_features(
    summary: DataFrame,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature columns, target, and the deal value (null as 0) that the loss needs later."""
    missing = [c for c in [*numeric, *categorical, TARGET] if c not in summary.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return summary.select(
        "lead_id",
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *categorical,
        F.col(TARGET).cast("int").alias(TARGET),
        F.coalesce(F.col("deal_value").cast("double"), F.lit(0.0)).alias("deal_value"),
        *keep,
    )


def target_distribution(features: DataFrame) -> DataFrame:
    total = features.agg(F.count(F.lit(1)).alias("n")).scalar()
    return features.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def impute_and_scale(features: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Median in place of nulls, then (x - mean) / sd with the population sd."""
    medians = [quantiles(features, c, {"m": 0.5}) for c in numeric]
    filled = features.select(
        "lead_id", *[F.coalesce(F.col(c), m.scalar()).alias(c) for c, m in zip(numeric, medians)])
    moments = filled.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in numeric
    ]).alias("moments")).scalar()
    return filled.select("lead_id", *[
        ((F.col(c) - moments[c]["mean"]) / F.when(moments[c]["sd"] == 0, 1.0).otherwise(moments[c]["sd"])).alias(c)
        for c in numeric
    ])


def class_weights(features: DataFrame) -> DataFrame:
    """Balanced weight n / (classes * n of the class), and the positive weight negatives / positives."""
    totals = features.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.count_distinct(TARGET).alias("classes"),
        F.count_if(F.col(TARGET) == 1).alias("positives")).alias("t")).scalar()
    positive_weight = (totals["n"] - totals["positives"]) / F.greatest(totals["positives"], F.lit(1))
    return features.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n")).select(
        TARGET, "n",
        (totals["n"] / (totals["classes"] * F.col("n"))).alias("balanced_weight"),
        F.when(F.col(TARGET) == 1, positive_weight).otherwise(1.0).alias("boosting_weight"),
    )


def rule_scores(summary: DataFrame) -> DataFrame:
    """Conversion rate of the lead's (source, industry) group: a score that plain SQL can follow."""
    rates = measured(summary.groupBy("lead_source", "industry").agg(
        F.round(F.sum("event_converted") / F.count(F.lit(1)), 6).alias("conversion_probability")))
    same_group = summary["lead_source"].eqNullSafe(rates["lead_source"]) & summary["industry"].eqNullSafe(rates["industry"])
    return summary.join(rates, same_group, "left").select(
        summary["lead_id"], "conversion_probability",
        F.coalesce(summary["deal_value"], F.lit(0.0)).alias("deal_value"), summary[TARGET])


def tier_thresholds(scores: DataFrame, low: float = 0.20, high: float = 0.80) -> DataFrame:
    return quantiles(scores, "conversion_probability", {"q20": low, "q80": high})


def business_outputs(scores: DataFrame) -> DataFrame:
    """Tier from the batch quantiles of the unrounded score, and expected loss; then rounding.

    The best fifth is "Low" risk and the worst fifth "High" risk.
    """
    limits = tier_thresholds(scores)
    q20, q80 = limits.select("q20").scalar(), limits.select("q80").scalar()
    p = F.col("conversion_probability")
    tier = F.when(p >= q80, "Low").when(p >= q20, "Medium").otherwise("High")
    return scores.select(
        "lead_id",
        F.round(p, 6).alias("conversion_probability"),
        tier.alias("risk_tier"),
        F.bround((1 - p) * F.col("deal_value"), 2).alias("expected_loss"),
    )


def tier_counts(rows: DataFrame, column: str, tiers: Sequence[str]) -> DataFrame:
    """Count per tier in a fixed order; a tier nobody has counts 0."""
    counts = [F.count_if(F.col(column) == t).alias(f"t{i}") for i, t in enumerate(tiers)]
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(t).alias(column), F.col(f"t{i}").alias("leads"))
        for i, t in enumerate(tiers)
    ]
    return rows.agg(*counts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def confusion_metrics(scored: DataFrame, threshold: float = 0.5, group: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 above a threshold; a zero division gives 0."""
    hit = F.col("conversion_probability") > threshold
    real = F.col(TARGET) == 1
    counts = scored.groupBy(*group).agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"), F.count_if(~hit & ~real).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def rate(num, den):
        return F.round(F.coalesce(nullable_div(num, den), F.lit(0.0)), 4)

    return counts.select(
        *group, "tp", "fp", "fn", "tn",
        rate(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"),
        rate(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def mann_whitney(scored: DataFrame, score: str = "conversion_probability", target: str = TARGET) -> DataFrame:
    """Area under the ROC curve as the share of (positive, negative) pairs in order, ties counting one half: the
    positives' sum of average ranks. Null where a class is absent. Scores are counted before they are ranked."""
    known = scored.filter(F.col(score).isNotNull() & F.col(target).isNotNull())
    cells = measured(known.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(target).cast("long")).alias("positives")))
    placed = running_total(cells, [F.col("score")], "rows")
    average = F.col("running") - F.col("rows") + (F.col("rows") + 1) / 2
    sums = placed.agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"), F.coalesce(F.sum(F.col("rows") - F.col("positives")), F.lit(0)).alias("negatives"),
        F.sum(average * F.col("positives")).alias("ranks"))
    p, n = F.col("positives"), F.col("negatives")
    return sums.select("positives", "negatives", F.try_divide(F.col("ranks") - p * (p + 1) / 2, p * n).alias("auc"))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and rows of each class, the accuracy, and the plain and the weighted mean over classes.

    ``counts`` has tp, fp, fn, tn; a zero division gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def rate(num, den):
        return F.coalesce(nullable_div(num, den), F.lit(0.0))

    def line(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("line"), rate(hit, hit + wrong).alias("precision"), rate(hit, hit + missed).alias("recall"),
            rate(2 * hit, 2 * hit + wrong + missed).alias("f1"), (hit + missed).alias("support"))

    lines = counts.select(tp, fp, fn, tn, line("0", tn, fn, fp).alias("no"), line("1", tp, fp, fn).alias("yes"))
    total = F.col("no.support") + F.col("yes.support")

    def mean(name: str, share_no, share_yes) -> Column:
        return F.struct(F.lit(name).alias("line"), *[
            (share_no * F.col(f"no.{m}") + share_yes * F.col(f"yes.{m}")).alias(m) for m in ("precision", "recall", "f1")], total.alias("support"))

    right = rate(tp + tn, tp + fp + fn + tn)
    accuracy = F.struct(F.lit("accuracy").alias("line"), right.alias("precision"), right.alias("recall"), right.alias("f1"), total.alias("support"))
    macro = mean("macro avg", F.lit(0.5), F.lit(0.5))
    weighted = mean("weighted avg", rate(F.col("no.support"), total), rate(F.col("yes.support"), total))
    return lines.select(F.explode(F.array("no", "yes", accuracy, macro, weighted)).alias("l")).select(
        "l.line", *[F.round(f"l.{m}", 4).alias(m) for m in ("precision", "recall", "f1")], "l.support")


def calibration(scored: DataFrame) -> DataFrame:
    """Mean score and real rate in five right-closed score bins; a score of 0 is in none."""
    # The labels that the report shows.
    labels = ["0-20%", "20-40%", "40-60%", "60-80%", "80-100%"]
    bins = right_closed_bins(F.col("conversion_probability"), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], labels)
    return (
        scored.filter(F.col(TARGET).isNotNull()).withColumn("prob_bin", bins).filter("prob_bin is not null")
        .groupBy("prob_bin").agg(
            F.avg("conversion_probability").alias("predicted"), F.avg(TARGET).alias("actual"),
            F.count("lead_id").alias("leads"))
    )
