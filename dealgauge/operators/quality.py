"""Keys, references, required values, text lengths, row counts and quality checks.

Every check returns its violations or counts as a DataFrame; nothing is enforced silently.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealgauge.functions import blank

# Primary key of each table, and the "at most one per lead" rules. The raw tables
# are listed too: their violations are what cleaning has to remove.
PRIMARY_KEYS = {
    "raw_leads": ["lead_id"], "raw_opportunities": ["opportunity_id"], "raw_activities": ["activity_id"],
    "raw_campaign_touches": ["touch_id"],
    "leads_clean": ["lead_id"], "opportunities_clean": ["opportunity_id"],
    "activities_clean": ["activity_id"], "campaign_touches_clean": ["touch_id"],
    "dim_time": ["date_id"], "dim_leads": ["lead_id"], "fact_activities": ["activity_id"],
    "fact_opportunities": ["opportunity_id"], "fact_campaign_touches": ["touch_id"],
    "lead_summary": ["lead_id"],
    "ml_lead_scores": ["lead_id"], "ml_survival_predictions": ["lead_id"],
    "ml_clv_predictions": ["lead_id"], "ml_uplift_predictions": ["lead_id"],
}
ONE_PER_LEAD = ["opportunities_clean", "campaign_touches_clean"]
LEAD_REFERENCES = [
    "raw_opportunities", "raw_activities", "raw_campaign_touches",
    "opportunities_clean", "activities_clean", "campaign_touches_clean",
    "fact_opportunities", "fact_activities", "fact_campaign_touches",
]
DATE_REFERENCES = {
    "dim_leads": ["created_date"], "fact_activities": ["date_id"], "fact_campaign_touches": ["date_id"],
    "fact_opportunities": ["open_date_id", "expected_close_date_id", "actual_close_date_id"],
}
REQUIRED = {"leads_clean": ["company_size_missing"], "opportunities_clean": ["deal_value_outlier"]}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(keys: DataFrame) -> DataFrame:
    """Repeated or null keys among (table_name, key_column, key_value) rows."""
    repeated = keys.groupBy("table_name", "key_column", "key_value").agg(F.count(F.lit(1)).alias("copies"))
    return repeated.filter((F.col("copies") > 1) | F.col("key_value").isNull())


def tagged_keys(rows: DataFrame, table: str, key: str) -> DataFrame:
    return rows.select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), F.col(key).cast("string").alias("key_value"))


def _present(tables: Mapping[str, DataFrame], needed: Iterable[str]) -> None:
    absent = sorted(set(needed) - set(tables))
    if absent:
        raise ValueError(f"tables to check are absent: {absent}")


def pk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated or null keys; every table with a rule has to be there."""
    _present(tables, [*PRIMARY_KEYS, *ONE_PER_LEAD])
    # All keys go through one aggregate: counted where they are read, then one exchange for all tables.
    parts = [tagged_keys(tables[t], t, key) for t, keys in PRIMARY_KEYS.items() for key in keys]
    parts += [tagged_keys(tables[t].filter("lead_id is not null"), t, "lead_id") for t in ONE_PER_LEAD]
    return duplicate_keys(_union(parts))


def missing_references(rows: DataFrame, table: str, column: str, target: DataFrame, target_key: str) -> DataFrame:
    """Values that the target lacks, with their row counts; null refers to nothing and passes.

    Rows are counted per value before the join, so a value shared by very many rows is one row.
    """
    used = (
        rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("ref"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = target.select(F.col(target_key).alias("known"))
    return used.join(known, used["ref"] == known["known"], "left_anti").select(
        F.lit(table).alias("table_name"), F.lit(column).alias("ref_column"),
        F.col("ref").cast("string").alias("ref_value"), "rows")


def fk_violations(tables: Mapping[str, DataFrame], leads: DataFrame, dates: DataFrame) -> DataFrame:
    _present(tables, [*LEAD_REFERENCES, *DATE_REFERENCES])
    parts = [missing_references(tables[t], t, "lead_id", leads, "lead_id") for t in LEAD_REFERENCES]
    for table, columns in DATE_REFERENCES.items():
        parts += [missing_references(tables[table], table, c, dates, "date_id") for c in columns]
    return _union(parts)


def required_values(tables: Mapping[str, DataFrame], required: Mapping[str, list[str]] = REQUIRED) -> DataFrame:
    """Number of nulls in each required column."""
    return _union([
        tables[t].agg(F.count_if(F.col(c).isNull()).alias("nulls")).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "nulls")
        for t, columns in required.items() for c in columns
    ])


def text_lengths(tables: Mapping[str, DataFrame], limits: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Longest text and number of texts over the limit, one scan per table."""
    parts = []
    for table, columns in limits.items():
        pairs = F.array(*[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(n).alias("length_limit"),
                F.coalesce(F.max(F.length(c)), F.lit(0)).alias("longest"),
                F.count_if(F.length(c) > n).alias("too_long"),
            ) for c, n in columns.items()
        ])
        parts.append(tables[table].agg(pairs.alias("p")).select(
            F.lit(table).alias("table_name"), F.explode("p").alias("p")).select("table_name", "p.*"))
    return _union(parts)


def row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    return _union([
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
        for layer, tables in layers.items() for table, rows in tables.items()
    ])


def layer_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("layer").agg(F.sum("row_count").alias("row_count"))


def quality_checks(summary: DataFrame) -> DataFrame:
    """All five checks in one pass."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_leads"),
        F.count_if(F.col("lead_id").isNull()).alias("missing_lead_ids"),
        F.count_if(blank(F.col("company_name"))).alias("missing_company_names"),
        F.count_if(blank(F.col("region"))).alias("missing_regions"),
        F.count_if(blank(F.col("status"))).alias("missing_statuses"),
        F.count_if(F.col("deal_value") < 0).alias("negative_deal_values"),
    )


def quality_issue_list(checks: DataFrame) -> DataFrame:
    """Check and number of issues as rows, with the total last."""
    names = {
        "Missing Lead IDs": "missing_lead_ids", "Missing Company Names": "missing_company_names",
        "Missing Regions": "missing_regions", "Missing Statuses": "missing_statuses",
        "Negative Deal Values": "negative_deal_values",
    }
    total = reduce(lambda a, b: a + b, [F.col(c) for c in names.values()])
    entries = [F.struct(F.lit(label).alias("check_name"), F.col(c).alias("issues")) for label, c in names.items()]
    entries.append(F.struct(F.lit("Total").alias("check_name"), total.alias("issues")))
    return checks.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
