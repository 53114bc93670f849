"""Report queries over the lead summary and the prediction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealgauge.functions import bin_index, nullable_div, right_closed_bins
from dealgauge.operators.ranks import percent_rank_average
from dealgauge.operators.uplift import ARMS

# Fixed values.
FUNNEL = ["New", "Contacted", "Qualified", "Converted"]
EXITS = ["Lost", "Unqualified"]
STATUS_RISK = {
    "Lost": 1.0, "Unqualified": 0.85, "New": 0.55, "Contacted": 0.45, "Qualified": 0.30, "Converted": 0.10,
}
UNKNOWN_STATUS_RISK = 0.5
MAP_METRICS = {
    "Leads": "total_leads", "Conversion Rate": "conversion_rate", "CLV": "total_clv", "Risk": "high_risk_count",
}


def _converted() -> Column:
    return F.col("status") == "Converted"


def _rows() -> Column:
    return F.count(F.lit(1))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 when there are no rows."""
    return F.coalesce(nullable_div(part * 100, whole), F.lit(0.0))


def portfolio(summary: DataFrame) -> DataFrame:
    """The columns the reports use; a missing deal value counts as 0 here, unlike in SQL averages."""
    return summary.select(
        "lead_id", "company_name", "industry", "company_size", "job_title", "lead_source", "country", "region",
        "status", "created_date", "total_activities", "received_campaign", "campaign_response", "treatment_group",
        "opportunity_stage", F.coalesce("deal_value", F.lit(0.0)).alias("deal_value"), "actual_close_date",
        "duration_days")


def keep_selected(rows: DataFrame, selections: Mapping[str, Sequence[str]]) -> DataFrame:
    """Multi-value filters; an empty selection means no filter on that column."""
    for column, values in selections.items():
        if values:
            rows = rows.filter(F.col(column).isin(*values))
    return rows


def search(rows: DataFrame, pattern: str) -> DataFrame:
    """Rows whose id or company matches the regular expression in any case; null never matches."""
    insensitive = F.lit("(?i)" + pattern)
    hit = F.coalesce(F.regexp_like("lead_id", insensitive), F.lit(False)) | F.coalesce(
        F.regexp_like("company_name", insensitive), F.lit(False))
    return rows.filter(hit)


def customer_kpis(rows: DataFrame) -> DataFrame:
    return rows.agg(
        _rows().alias("total_customers"), F.count_if(_converted()).alias("converted"),
        F.coalesce(F.sum("deal_value"), F.lit(0.0)).alias("pipeline_value"),
    ).withColumn("conversion_rate", percentage(F.col("converted"), F.col("total_customers")))


def customer_portfolio(rows: DataFrame) -> DataFrame:
    return rows.select(
        "lead_id", "company_name", "industry", "company_size", "job_title", "region", "lead_source",
        "total_activities", "status", "opportunity_stage", "deal_value")


def funnel(rows: DataFrame) -> DataFrame:
    """Leads that reached each stage, and the loss against the stage before; exits are left out."""
    counts = rows.agg(*[
        F.count_if(F.col("status").isin(*FUNNEL[i:])).alias(f"c{i}") for i in range(len(FUNNEL))])
    steps = []
    for i, stage in enumerate(FUNNEL):
        lost = nullable_div((F.col(f"c{i - 1}") - F.col(f"c{i}")) * 100, F.col(f"c{i - 1}")) if i else F.lit(0.0)
        steps.append(F.struct(
            F.lit(i).alias("step"), F.lit(stage).alias("stage"), F.col(f"c{i}").alias("leads"),
            F.bround(lost, 1).alias("dropoff_pct")))
    return counts.select(F.explode(F.array(*steps)).alias("s")).select("s.*")


def funnel_exits(rows: DataFrame) -> DataFrame:
    total = rows.agg(_rows()).scalar()
    return rows.filter(F.col("status").isin(*EXITS)).groupBy("status").agg(_rows().alias("leads")).withColumn(
        "share", F.col("leads") / total)


def customer_360(rows: DataFrame, lead_id: str) -> DataFrame:
    average = rows.agg(F.avg("total_activities")).scalar()
    return rows.filter(F.col("lead_id") == lead_id).withColumn(
        "activities_vs_average", F.col("total_activities") - average)


def activity_and_duration_ranks(rows: DataFrame) -> DataFrame:
    """Percentage ranks of activities and duration; a missing duration counts as the median one."""
    # Durations are whole days, so the percentile buffer is small.
    typical = rows.agg(F.percentile("duration_days", 0.5)).scalar()
    filled = rows.withColumn("rank_activities", F.coalesce("total_activities", F.lit(0))).withColumn(
        "rank_duration", F.coalesce(F.col("duration_days").cast("double"), typical))
    ranked = percent_rank_average(filled, "rank_activities", "activity_rank")
    return percent_rank_average(ranked, "rank_duration", "duration_rank").drop("rank_activities", "rank_duration")


def proxy_risk(rows: DataFrame) -> DataFrame:
    """Risk from status, inverse activity rank, duration rank and a missing campaign response."""
    ranked = activity_and_duration_ranks(rows)
    status = F.lit(UNKNOWN_STATUS_RISK)
    for name, weight in STATUS_RISK.items():
        status = F.when(F.col("status") == name, weight).otherwise(status)
    inactivity = 1 - F.col("activity_rank")
    silent = F.col("campaign_response").isNull() | F.col("campaign_response").isin("No Response", "None")
    ignored = F.when(F.coalesce("received_campaign", F.lit(False)) & silent, 1.0).otherwise(0.0)
    score = 0.45 * status + 0.20 * inactivity + 0.20 * F.col("duration_rank") + 0.15 * ignored
    usual_deal = F.coalesce(rows.filter("deal_value > 0").agg(F.avg("deal_value")).scalar(), F.lit(0.0))
    # Tiers are cut by the score as it is; six decimals are only shown.
    scored = ranked.withColumn("whole_score", F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)))
    return scored.withColumn(
        "risk_tier", right_closed_bins(F.col("whole_score"), [-0.01, 0.4, 0.7, 1.0], ["Low", "Medium", "High"])
    ).withColumn(
        "exposure", F.when(F.col("deal_value") > 0, F.col("deal_value")).otherwise(usual_deal)
    ).withColumn("expected_loss", F.col("whole_score") * F.col("exposure")).withColumn(
        "risk_score", F.round("whole_score", 6)).drop("whole_score")


def risk_kpis(risks: DataFrame) -> DataFrame:
    return risks.agg(
        _rows().alias("total_customers"), F.count_if(F.col("risk_tier") == "High").alias("high_risk"),
        F.coalesce(F.sum("exposure"), F.lit(0.0)).alias("total_exposure"),
        F.coalesce(F.sum("expected_loss"), F.lit(0.0)).alias("total_expected_loss"),
        F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("avg_risk_score"),
    ).withColumn("high_risk_rate", percentage(F.col("high_risk"), F.col("total_customers")))


def histogram(rows: DataFrame, value: str, bins: int, colour: str | None = None) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value; empty bins are absent."""
    known = rows.filter(F.col(value).isNotNull())
    span = known.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("s")).scalar()
    keys = [bin_index(F.col(value), span["low"], span["high"], bins).alias("bin")]
    if colour:
        keys.append(F.col(colour))
    width = (span["high"] - span["low"]) / bins
    return known.groupBy(*keys).agg(_rows().alias("leads")).withColumn(
        "bin_start", span["low"] + F.col("bin") * width)


def mean_by(rows: DataFrame, key: str, value: str, out: str, n: int | None = None) -> DataFrame:
    means = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(out)).orderBy(F.desc(out), key)
    return means.limit(n) if n else means


def sum_by(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(value)).orderBy(F.desc(value), key)


def top(rows: DataFrame, value: str, n: int, columns: Sequence[str], ascending: bool = False) -> DataFrame:
    """Best n rows; equal values are ordered by lead id."""
    order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    return rows.orderBy(order, "lead_id").limit(n).select(*columns)


def campaign_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("received_campaign") & F.col("treatment_group").isin(*ARMS))


def intervention_summary(rows: DataFrame) -> DataFrame:
    won = F.when(F.col("opportunity_stage") == "Closed-Won", F.col("deal_value")).otherwise(0.0)
    return campaign_rows(rows).groupBy("treatment_group").agg(
        F.count("lead_id").alias("leads"), F.count_if(_converted()).alias("conversions"),
        F.sum(won).alias("won_revenue"),
    ).withColumn("conversion_rate", percentage(F.col("conversions"), F.col("leads")))


def intervention_effect(summary_by_arm: DataFrame) -> DataFrame:
    """Treatment against control in one row; an absent arm counts as 0."""
    def of(arm: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("treatment_group") == arm, F.col(column))), F.lit(0))

    arms = summary_by_arm.agg(
        of("Treatment", "leads").alias("treatment_leads"), of("Treatment", "conversions").alias("treatment_conversions"),
        of("Treatment", "conversion_rate").alias("treatment_rate"), of("Control", "conversion_rate").alias("control_rate"),
        (of("Treatment", "won_revenue") - of("Control", "won_revenue")).alias("revenue_difference"))
    return arms.withColumn("uplift_pp", F.col("treatment_rate") - F.col("control_rate")).withColumn(
        "additional_conversions",
        F.col("treatment_conversions") - F.col("treatment_leads") * F.col("control_rate") / 100)


def response_by_arm(rows: DataFrame) -> DataFrame:
    return campaign_rows(rows).filter("campaign_response is not null").groupBy(
        "campaign_response", "treatment_group").agg(F.count("lead_id").alias("leads"))


def uplift_by_source(rows: DataFrame) -> DataFrame:
    """Conversion rate per source and arm side by side, sources with both arms only."""
    rate = percentage(F.count_if(_converted()), F.count("lead_id"))
    wide = campaign_rows(rows).filter("lead_source is not null").groupBy("lead_source").pivot(
        "treatment_group", ["Control", "Treatment"]).agg(rate)
    return wide.select(
        "lead_source", F.col("Control").alias("control_rate"), F.col("Treatment").alias("treatment_rate"),
        (F.col("Treatment") - F.col("Control")).alias("uplift_pp"),
    ).dropna(subset=["uplift_pp"]).orderBy(F.desc("uplift_pp"), "lead_source")


def best_source_uplift(by_source: DataFrame) -> DataFrame:
    return by_source.orderBy(F.desc("uplift_pp"), "lead_source").limit(1).select("lead_source", "uplift_pp")


def scored_leads(scores: DataFrame, summary: DataFrame) -> DataFrame:
    details = summary.select(
        "lead_id", "company_name", "industry", "region", "lead_source", "job_title", "company_size", "status",
        "deal_value", "event_converted", "duration_days")
    return scores.select("lead_id", "conversion_probability", "risk_tier", "expected_loss").join(
        details, "lead_id", "left")


def score_kpis(scored: DataFrame) -> DataFrame:
    return scored.agg(
        _rows().alias("leads"), F.avg("conversion_probability").alias("mean_probability"),
        F.sum("expected_loss").alias("total_expected_loss"), F.avg("event_converted").alias("actual_rate"))


def clv_detail(values: DataFrame, scores: DataFrame, summary: DataFrame) -> DataFrame:
    return (
        values.select(
            "lead_id", "clv_discounted", "clv_undiscounted", "clv_tier", "conversion_probability",
            "effective_deal_value", "median_years", "discount_factor", "industry", "lead_source", "region")
        .join(scores.select("lead_id", "risk_tier"), "lead_id", "left")
        .join(summary.select("lead_id", "event_converted"), "lead_id", "left")
    )


def clv_quadrant(values: DataFrame, min_leads: int = 100) -> DataFrame:
    return values.groupBy("industry", "lead_source").agg(
        F.avg("conversion_probability").alias("mean_prob"), F.avg("clv_discounted").alias("mean_clv"),
        F.count("lead_id").alias("n_leads")).filter(F.col("n_leads") >= min_leads)


def clv_by(values: DataFrame, key: str) -> DataFrame:
    return values.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg("clv_discounted").alias("mean_clv"), F.sum("clv_discounted").alias("total_clv"),
        F.count("lead_id").alias("n")).orderBy(F.desc("mean_clv"), key)


def best_clv_segments(values: DataFrame) -> DataFrame:
    """Industry and source with the highest mean value."""
    best = [
        clv_by(values, key).limit(1).select(
            F.lit(key).alias("segment_by"), F.col(key).alias("segment"), "mean_clv")
        for key in ("industry", "lead_source")
    ]
    return best[0].unionByName(best[1])


def country_metrics(summary: DataFrame, scores: DataFrame, values: DataFrame) -> DataFrame:
    event = F.col("event_converted") == 1
    return (
        summary.select("lead_id", "country", "region", "event_converted", "deal_value")
        .join(scores.select("lead_id", "risk_tier"), "lead_id", "left")
        .join(values.select("lead_id", "clv_discounted"), "lead_id", "left")
        .groupBy("country", "region").agg(
            _rows().alias("total_leads"), F.count_if(event).alias("conversions"),
            F.avg(F.when(event, 1.0).otherwise(0.0)).alias("conversion_rate"),
            F.avg("deal_value").alias("avg_deal_value"), F.sum("deal_value").alias("total_deal_value"),
            F.count_if(F.col("risk_tier") == "High").alias("high_risk_count"),
            F.avg("clv_discounted").alias("avg_clv"), F.sum("clv_discounted").alias("total_clv"))
        .filter("total_leads > 0").orderBy(F.desc("total_leads"), "country")
    )


def map_kpis(countries: DataFrame) -> DataFrame:
    return countries.agg(
        F.count_if(F.col("total_leads") > 0).alias("countries"), F.sum("total_leads").alias("total_leads"),
        F.sum("conversions").alias("conversions"),
        F.coalesce(F.sum("total_clv"), F.lit(0.0)).alias("total_clv"),
    ).withColumn("global_conversion", F.coalesce(nullable_div(F.col("conversions"), F.col("total_leads")), F.lit(0.0)))


def top_countries(countries: DataFrame, metric: str, n: int = 10) -> DataFrame:
    """Best countries by one of the map metrics."""
    metric = MAP_METRICS[metric]
    return countries.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), "country").limit(n).select("country", metric)


def region_rollup(countries: DataFrame) -> DataFrame:
    return countries.filter("region is not null").groupBy("region").agg(
        F.sum("total_leads").alias("total_leads"), F.sum("conversions").alias("conversions"),
    ).withColumn("conversion_rate", nullable_div(F.col("conversions"), F.col("total_leads"))).orderBy(
        F.desc("conversion_rate"), "region")


def country_drilldown(countries: DataFrame, country: str) -> DataFrame:
    return countries.filter(F.col("country") == country).select(
        "country", "total_leads", "conversions", "conversion_rate", "avg_clv")


def dashboard_kpis(risks: DataFrame, checks: DataFrame) -> DataFrame:
    """Leads, conversion, won revenue, at-risk and high-risk leads, and open quality issues."""
    issues = checks.select((
        F.col("missing_lead_ids") + F.col("missing_company_names") + F.col("missing_regions")
        + F.col("missing_statuses") + F.col("negative_deal_values")).alias("i")).scalar()
    return risks.agg(
        _rows().alias("total_leads"), F.count_if(_converted()).alias("converted"),
        F.coalesce(F.sum(F.when(F.col("opportunity_stage") == "Closed-Won", F.col("deal_value"))), F.lit(0.0)).alias("won_revenue"),
        F.count_if(F.col("status").isin(*EXITS)).alias("at_risk"),
        F.count_if(F.col("risk_tier") == "High").alias("high_risk"),
    ).withColumn("conversion_rate", percentage(F.col("converted"), F.col("total_leads"))).withColumn(
        "quality_issues", issues)


def conversion_by(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("lead_id").alias("leads"), F.count_if(_converted()).alias("conversions"),
    ).withColumn("conversion_rate", percentage(F.col("conversions"), F.col("leads"))).orderBy(
        F.desc("conversion_rate"), key)


def overview_kpis(rows: DataFrame) -> DataFrame:
    won = F.when(F.col("opportunity_stage") == "Closed-Won", F.col("deal_value"))
    return rows.agg(
        _rows().alias("total_leads"), F.count_if(_converted()).alias("converted"),
        F.count_if(F.col("status").isin(*EXITS)).alias("at_risk"),
        F.coalesce(F.sum(won), F.lit(0.0)).alias("won_revenue"), F.coalesce(F.avg(won), F.lit(0.0)).alias("avg_won_deal"),
        F.coalesce(F.sum("deal_value"), F.lit(0.0)).alias("exposure"),
    ).withColumn("conversion_rate", percentage(F.col("converted"), F.col("total_leads"))).withColumn(
        "at_risk_rate", percentage(F.col("at_risk"), F.col("total_leads")))


def monthly_trend(rows: DataFrame, months: int = 12) -> DataFrame:
    """Leads and conversions of the latest months in time order."""
    monthly = rows.groupBy(F.trunc("created_date", "month").alias("month_start")).agg(
        F.count("lead_id").alias("leads"), F.count_if(_converted()).alias("converted"))
    latest = monthly.filter("month_start is not null").orderBy(F.desc("month_start")).limit(months)
    return latest.select(
        "month_start", F.date_format("month_start", "MMM yyyy").alias("month"), "leads", "converted",
        percentage(F.col("converted"), F.col("leads")).alias("conversion_rate")).orderBy("month_start")


def count_by(rows: DataFrame, key: str, n: int | None = None) -> DataFrame:
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("lead_id").alias("leads")).orderBy(
        F.desc("leads"), key)
    return counts.limit(n) if n else counts


def recent_customers(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.orderBy(F.desc("created_date"), "lead_id").limit(n).select(
        "lead_id", "company_name", "industry", "region", "status", "opportunity_stage", "deal_value", "created_date")


def filter_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct values of every filter column, null left out, in one pass."""
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value")) for c in columns]))
    return rows.select(entries.alias("e")).select("e.*").filter("value is not null").distinct().orderBy("filter_name", "value")


def conversion_profile(summary: DataFrame) -> DataFrame:
    """Conversion overall, by source, by industry and by campaign flag, in one pass."""
    entries = F.explode(F.array(
        F.struct(F.lit("overall").alias("profile"), F.lit("all").alias("value")),
        F.struct(F.lit("lead_source").alias("profile"), F.col("lead_source").alias("value")),
        F.struct(F.lit("industry").alias("profile"), F.col("industry").alias("value")),
        F.struct(F.lit("received_campaign").alias("profile"), F.col("received_campaign").cast("string").alias("value"))))
    return summary.select("event_converted", entries.alias("e")).filter("e.value is not null").groupBy(
        "e.profile", "e.value").agg(F.round(F.avg("event_converted"), 3).alias("conversion_rate"), _rows().alias("leads"))


def fastest_leads(predictions: DataFrame, summary: DataFrame, n: int = 10) -> DataFrame:
    """Leads predicted to convert first. The limit comes before the join."""
    known = predictions.select("lead_id", "predicted_median_days").filter("predicted_median_days is not null")
    first = known.orderBy("predicted_median_days", "lead_id").limit(n)
    details = summary.select("lead_id", "lead_source", "industry", "region", "duration_days", "event_converted")
    return first.join(details, "lead_id", "left").select(
        "lead_id", "lead_source", "industry", "region", "predicted_median_days",
        (F.col("predicted_median_days") / 365.25).alias("predicted_years"), "duration_days", "event_converted"
    ).orderBy("predicted_median_days", "lead_id")


def summary_lines(summaries: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Labels and values of several summaries as one table: name -> (rows, label column, value column)."""
    parts = [
        rows.select(F.lit(name).alias("summary"), F.col(label).cast("string").alias("label"), F.col(value).cast("double").alias("value"))
        for name, (rows, label, value) in summaries.items()]
    return reduce(DataFrame.unionByName, parts)
