"""Campaign cohort, two-arm scores, uplift segments and the Qini curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealgauge.functions import share
from dealgauge.operators.ranks import SINGLE_TASK_ROWS, quantiles, running_total
from dealgauge.sources.stages import measured

ARMS = ["Treatment", "Control"]
SEGMENTS = ["Persuadable", "Sure Thing", "Lost Cause", "Do Not Disturb"]


def campaign_cohort(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("received_campaign") & F.col("treatment_group").isin(*ARMS)).select(
        "lead_id", "treatment_group", "event_converted", "total_activities", "company_size",
        "industry", "lead_source", "region", "job_title")


def arm_outcomes(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("treatment_group", "event_converted").agg(F.count(F.lit(1)).alias("n")).orderBy(
        "treatment_group", "event_converted")


def arm_rates(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("treatment_group").agg(
        F.avg("event_converted").alias("conv_rate"), F.count(F.lit(1)).alias("n"))


def segment_rate_scores(cohort: DataFrame, prior_weight: int = 10) -> DataFrame:
    """Two-arm scores from smoothed group rates; plain SQL can follow it.

    The rate of a (source, industry) group in an arm is pulled towards the rate of the arm.
    """
    def arm_sums(arm: str) -> list[Column]:
        of_arm = F.col("treatment_group") == arm
        tag = arm[0].lower()
        return [F.count_if(of_arm).alias(f"n_{tag}"), F.sum(F.when(of_arm, F.col("event_converted")).otherwise(0)).alias(f"y_{tag}")]

    cells = measured(cohort.groupBy("lead_source", "industry").agg(*arm_sums("Treatment"), *arm_sums("Control")))
    arms = cells.agg(F.struct(
        (F.sum("y_t") / F.sum("n_t")).alias("t"), (F.sum("y_c") / F.sum("n_c")).alias("c")).alias("r")).scalar()

    def smoothed(tag: str) -> Column:
        rate = (F.col(f"y_{tag}") + prior_weight * arms[tag]) / (F.col(f"n_{tag}") + prior_weight)
        return F.round(rate, 6)

    rated = measured(
        cells.select("lead_source", "industry", smoothed("t").alias("p_treatment"), smoothed("c").alias("p_control")))
    same_group = cohort["lead_source"].eqNullSafe(rated["lead_source"]) & cohort["industry"].eqNullSafe(rated["industry"])
    scores = with_uplift(cohort.join(rated, same_group, "left").drop(rated["lead_source"], rated["industry"]))
    # both rates have six decimals, and so has their difference
    return scores.withColumn("uplift", F.round("uplift", 6))


def with_uplift(scores: DataFrame) -> DataFrame:
    """The difference is not rounded: segments are cut by its value, and only what is shown is rounded."""
    return scores.select(
        "lead_id", "treatment_group", "event_converted", "industry", "lead_source", "region",
        "p_treatment", "p_control", (F.col("p_treatment") - F.col("p_control")).alias("uplift"))


def with_segment(scores: DataFrame, threshold: float = 0.05) -> DataFrame:
    base = quantiles(scores, "p_control", {"m": 0.5}).scalar()
    segment = (
        F.when(F.col("uplift") >= threshold, "Persuadable")
        .when(F.col("uplift") <= -threshold, "Do Not Disturb")
        .when(F.col("p_control") >= base, "Sure Thing")
        .otherwise("Lost Cause")
    )
    return scores.withColumn("uplift_segment", segment)


def uplift_stats(scores: DataFrame) -> DataFrame:
    cuts = quantiles(scores, "uplift", {"p10": 0.1, "median": 0.5, "p90": 0.9})
    return scores.agg(F.avg("uplift").alias("mean_uplift")).select(
        "mean_uplift",
        cuts.select("median").scalar().alias("median_uplift"),
        cuts.select("p90").scalar().alias("p90_uplift"),
        cuts.select("p10").scalar().alias("p10_uplift"),
    )


def uplift_summary(segmented: DataFrame) -> DataFrame:
    of = {s: F.col("uplift_segment") == s for s in SEGMENTS}
    return segmented.agg(
        F.count(F.lit(1)).alias("n_leads"),
        F.avg("uplift").alias("mean_uplift"),
        share(of["Persuadable"]).alias("share_persuadable"),
        share(of["Do Not Disturb"]).alias("share_do_not_disturb"),
        *[F.count_if(cond).alias("n_" + s.lower().replace(" ", "_")) for s, cond in of.items()],
    ).withColumn("median_uplift", quantiles(segmented, "uplift", {"m": 0.5}).scalar())


def qini_curve(scores: DataFrame, points: int = 25, start: float = 0.05, limit: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Extra conversions when the best part of the leads is targeted, and the random line.

    Every lead gets its global position by running total; leads are then counted per slot
    between two cuts, and the cuts (one row each) are summed up.
    """
    order = [F.desc("uplift"), F.asc("lead_id")]
    placed = running_total(
        scores.select("lead_id", "uplift", "treatment_group", "event_converted", F.lit(1).alias("one")),
        order, "one", limit)
    totals = scores.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("treatment_group") == "Treatment").alias("t"),
        F.count_if(F.col("treatment_group") == "Control").alias("c")).alias("x")).scalar()
    step = (1.0 - start) / (points - 1)
    fractions = [start + i * step for i in range(points - 1)] + [1.0]
    cuts = [F.floor(F.lit(f) * totals["n"]).cast("long") for f in fractions]
    slot = F.when(F.col("running") <= cuts[0], 0)
    for i in range(1, points):
        slot = slot.when(F.col("running") <= cuts[i], i)
    converted = F.col("event_converted") == 1
    per_slot = placed.groupBy(slot.alias("slot")).agg(
        F.count_if(converted & (F.col("treatment_group") == "Treatment")).alias("y_t"),
        F.count_if(converted & (F.col("treatment_group") == "Control")).alias("y_c"))
    frame = scores.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("cut"), F.lit(f).alias("fraction"), cuts[i].alias("n")) for i, f in enumerate(fractions)
    ])).alias("c")).select("c.*")
    upto = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ratio = F.when(totals["c"] > 0, totals["t"] / totals["c"]).otherwise(1.0)
    summed = frame.join(per_slot, frame["cut"] == per_slot["slot"], "left").select(
        "cut", "fraction", "n",
        (F.coalesce(F.sum("y_t").over(upto), F.lit(0)) - F.coalesce(F.sum("y_c").over(upto), F.lit(0)) * ratio).alias("qini"))
    last = F.max_by("qini", "cut").over(Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return summed.withColumn("random", F.col("fraction") * last).drop("cut")


def by_segment(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("uplift_segment").agg(
        F.count("lead_id").alias("n"), F.avg("uplift").alias("mean_uplift"),
        F.avg("p_treatment").alias("mean_p_treatment"), F.avg("p_control").alias("mean_p_control"),
    ).orderBy(F.desc("mean_uplift"))


def with_deal_value(segmented: DataFrame, summary: DataFrame) -> DataFrame:
    return segmented.join(summary.select("lead_id", "deal_value"), "lead_id", "left")


def top_of_segment(valued: DataFrame, segment: str, n: int, best_first: bool) -> DataFrame:
    order = F.desc("uplift") if best_first else F.asc("uplift")
    return valued.filter(F.col("uplift_segment") == segment).orderBy(order, "lead_id").limit(n).select(
        "lead_id", "industry", "lead_source", "region", "deal_value", "p_control", "p_treatment",
        "uplift", "event_converted")
