"""Raw tables to cleaned tables, with orphan activities put aside instead of lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealgauge.sources.stages import measured

from dealgauge.functions import parse_size

OUTLIER_DEAL_VALUE = 50_000_000
ORPHAN_REASON = "orphan_lead_id"

LEAD_COLUMNS = [
    "lead_id", "contact_name", "company_name", "industry", "company_size", "company_size_missing",
    "lead_source", "job_title", "country", "region", "status", "created_date",
]
OPPORTUNITY_COLUMNS = [
    "opportunity_id", "lead_id", "deal_value", "deal_value_outlier", "stage", "owner",
    "open_date", "expected_close_date", "actual_close_date",
]
ACTIVITY_COLUMNS = ["activity_id", "lead_id", "activity_date", "activity_type", "channel", "outcome"]
TOUCH_COLUMNS = ["touch_id", "lead_id", "campaign_id", "touch_date", "response", "treatment_group"]


def clean_leads(raw_leads: DataFrame) -> DataFrame:
    sized = raw_leads.withColumn("company_size", parse_size(F.col("company_size")))
    return sized.withColumn("company_size_missing", F.col("company_size").isNull()).select(LEAD_COLUMNS)


def flag_outliers(raw_opportunities: DataFrame) -> DataFrame:
    outlier = F.coalesce(F.col("deal_value") > OUTLIER_DEAL_VALUE, F.lit(False))
    return (
        raw_opportunities.withColumn("deal_value_outlier", outlier)
        .withColumn("deal_value", F.when(~F.col("deal_value_outlier"), F.col("deal_value")))
        .select(OPPORTUNITY_COLUMNS)
    )


def keep_first(rows: DataFrame, key: str, order: str = "ingest_seq") -> DataFrame:
    """First row of each key in read order.

    Catalyst turns ``row_number() = 1`` into a limit per key and task before the shuffle, so a
    key repeated in a third of the input is not gathered into one task; unused columns are pruned.
    """
    position = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("copy_number", position).filter("copy_number = 1").drop("copy_number")


def known_leads(leads: DataFrame) -> DataFrame:
    """The lead ids as a written table without buckets: an exchange lies between them and a join, as on the
    other side, so an id that very many rows share can be split."""
    return measured(leads.select("lead_id").filter("lead_id is not null").distinct())


def with_known_lead(rows: DataFrame, leads: DataFrame) -> DataFrame:
    return rows.join(known_leads(leads), "lead_id", "left_semi")


def without_known_lead(rows: DataFrame, leads: DataFrame) -> DataFrame:
    """Rows whose lead is unknown; a null lead id is unknown too."""
    return rows.join(known_leads(leads), "lead_id", "left_anti")


def clean_opportunities(raw_opportunities: DataFrame, leads: DataFrame) -> DataFrame:
    return with_known_lead(flag_outliers(raw_opportunities), leads).select(OPPORTUNITY_COLUMNS)


def clean_activities(raw_activities: DataFrame, leads: DataFrame) -> DataFrame:
    return with_known_lead(keep_first(raw_activities, "activity_id"), leads).select(ACTIVITY_COLUMNS)


def reject_activities(raw_activities: DataFrame, leads: DataFrame) -> DataFrame:
    orphans = without_known_lead(keep_first(raw_activities, "activity_id"), leads)
    return orphans.select(*ACTIVITY_COLUMNS, F.lit(ORPHAN_REASON).alias("rejection_reason"))


def check_activities(raw_activities: DataFrame, leads: DataFrame) -> DataFrame:
    """First copies of all activities with their rejection reason, null for valid ones.

    Valid and rejected rows come out of one pass; written partitioned by the reason, each side
    is then a folder of its own.
    """
    known = known_leads(leads).withColumn("known", F.lit(True))
    checked = keep_first(raw_activities, "activity_id").join(known, "lead_id", "left")
    reason = F.when(F.col("known").isNull(), ORPHAN_REASON)
    return checked.select(*ACTIVITY_COLUMNS, reason.alias("rejection_reason"))


def clean_touches(raw_touches: DataFrame, leads: DataFrame) -> DataFrame:
    return with_known_lead(keep_first(raw_touches, "touch_id"), leads).select(TOUCH_COLUMNS)


def cleaning_report(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Counters of the cleaning step, one row per counter."""
    def counter(rows: DataFrame, table: str, metric: str, value=F.count(F.lit(1))) -> DataFrame:
        return rows.agg(value.cast("long").alias("value")).select(
            F.lit(table).alias("table_name"), F.lit(metric).alias("metric"), "value"
        )

    parts = [counter(rows, name, "rows_in") for name, rows in raw.items()]
    parts += [counter(rows, name, "rows_out") for name, rows in clean.items()]
    parts.append(counter(clean["leads_clean"], "leads_clean", "company_size_missing", F.count_if("company_size_missing")))
    parts.append(counter(
        clean["opportunities_clean"], "opportunities_clean", "deal_value_outlier", F.count_if("deal_value_outlier")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def reject_profile(rejected: DataFrame) -> DataFrame:
    week = F.trunc("activity_date", "week").alias("week_start")
    return rejected.groupBy("rejection_reason", week).agg(F.count(F.lit(1)).alias("rejects"))
