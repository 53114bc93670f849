import datetime as dt

from pyspark.sql import functions as F

from dealgauge.operators import quality
from dealgauge.sources.schemas import TEXT_LIMITS


def test_duplicate_and_missing_keys(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "lead_id string")
    got = quality.duplicate_keys(quality.tagged_keys(rows, "leads_clean", "lead_id")).collect()
    assert sorted((r["key_value"] or "", r["copies"]) for r in got) == [("", 1), ("a", 2)]


def test_all_keys_take_one_exchange(spark, tmp_path):
    keys = {**quality.PRIMARY_KEYS, **{t: [*quality.PRIMARY_KEYS[t], "lead_id"] for t in quality.ONE_PER_LEAD}}
    tables = {}
    for i, (t, columns) in enumerate(keys.items()):
        spark.range(5).select(*[(F.col("id") % (5 - i % 2)).cast("string").alias(c) for c in dict.fromkeys(columns)]).write.parquet(str(tmp_path / t))
        tables[t] = spark.read.parquet(str(tmp_path / t))
    found = quality.pk_violations(tables)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = {(r["table_name"], r["key_column"]): (r["key_value"], r["copies"]) for r in found.collect()}
    assert got == {(t, c): ("0", 2) for i, (t, columns) in enumerate(keys.items()) if i % 2 for c in columns}


def test_missing_references(spark):
    rows = spark.createDataFrame([("L1",), ("L9",), ("L9",), (None,)], "lead_id string")
    leads = spark.createDataFrame([("L1",)], "lead_id string")
    got = quality.missing_references(rows, "t", "lead_id", leads, "lead_id").collect()
    assert [(r["ref_value"], r["rows"]) for r in got] == [("L9", 2)]


def test_date_references(spark):
    rows = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2030, 1, 1),), (None,)], "date_id date")
    days = spark.createDataFrame([(dt.date(2020, 1, 1),)], "date_id date")
    got = quality.missing_references(rows, "t", "date_id", days, "date_id").collect()
    assert [r["ref_value"] for r in got] == ["2030-01-01"]


def test_required_values_and_text_lengths(spark):
    rows = spark.createDataFrame([("x" * 21, True), ("y", None)], "lead_id string, company_size_missing boolean")
    assert quality.required_values({"leads_clean": rows}, {"leads_clean": ["company_size_missing"]}).first()["nulls"] == 1
    got = quality.text_lengths({"leads_clean": rows}, {"leads_clean": {"lead_id": TEXT_LIMITS["leads_clean"]["lead_id"]}}).first()
    assert (got["longest"], got["too_long"]) == (21, 1)


def test_quality_checks(spark):
    rows = spark.createDataFrame(
        [(None, " ", "r", "s", -1.0), ("L1", None, "", "s", None), ("L2", "c", "r", None, 1.0)],
        "lead_id string, company_name string, region string, status string, deal_value double")
    checks = quality.quality_checks(rows)
    assert checks.first().asDict() == {
        "total_leads": 3, "missing_lead_ids": 1, "missing_company_names": 2, "missing_regions": 1,
        "missing_statuses": 1, "negative_deal_values": 1}
    assert {r["check_name"]: r["issues"] for r in quality.quality_issue_list(checks).collect()}["Total"] == 6
