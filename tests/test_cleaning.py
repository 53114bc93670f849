import datetime as dt

from pyspark.sql import functions as F

from dealgauge.functions import parse_size, right_closed_bins
from dealgauge.operators import cleaning

DAY = dt.date(2020, 1, 1)


def test_sizes(spark):
    rows = spark.createDataFrame([(None,), ("",), ("163 emp",), ("23.0",), ("n/a",), ("1,200",), ("99999999999",)], "s string")
    assert [r[0] for r in rows.select(parse_size(F.col("s"))).collect()] == [None, None, 163, 23, None, 1, None]


def test_right_closed_bins(spark):
    rows = spark.createDataFrame([(0.0,), (0.4,), (0.41,), (1.0,), (1.2,), (None,)], "v double")
    labels = rows.select(right_closed_bins(F.col("v"), [0.0, 0.4, 1.0], ["low", "high"]))
    assert [r[0] for r in labels.collect()] == [None, "low", "high", "high", None, None]


def leads(spark):
    return spark.createDataFrame([("L1",), ("L2",)], "lead_id string")


def activities(spark):
    return spark.createDataFrame(
        [
            ("T1", "L1", DAY, "call", "Phone", "Neutral", 1),
            ("T1", "L9", DAY, "call", "Phone", "Neutral", 2),
            ("T2", "L9", DAY, "call", "Phone", "Neutral", 3),
            ("T2", "L2", DAY, "call", "Phone", "Neutral", 4),
            ("T3", None, DAY, "call", "Phone", "Neutral", 5),
        ],
        "activity_id string, lead_id string, activity_date date, activity_type string, channel string, outcome string, ingest_seq long")


def test_first_copy_decides_and_null_lead_is_rejected(spark):
    valid = cleaning.clean_activities(activities(spark), leads(spark)).collect()
    rejected = cleaning.reject_activities(activities(spark), leads(spark)).collect()
    assert [(r["activity_id"], r["lead_id"]) for r in valid] == [("T1", "L1")]
    assert sorted((r["activity_id"], r["lead_id"] or "") for r in rejected) == [("T2", "L9"), ("T3", "")]
    assert {r["rejection_reason"] for r in rejected} == {"orphan_lead_id"}


def test_one_pass_check_equals_the_two_sides(spark):
    checked = cleaning.check_activities(activities(spark), leads(spark))
    valid = checked.filter("rejection_reason is null").drop("rejection_reason")
    assert valid.collect() == cleaning.clean_activities(activities(spark), leads(spark)).collect()
    rejected = checked.filter("rejection_reason is not null")
    assert set(rejected.collect()) == set(cleaning.reject_activities(activities(spark), leads(spark)).collect())


def test_outliers_are_flagged_and_removed(spark):
    rows = spark.createDataFrame(
        [("O1", "L1", 5e7), ("O2", "L1", 5.1e7), ("O3", "L2", None), ("O4", "L9", 1.0)],
        "opportunity_id string, lead_id string, deal_value double")
    for c in ("stage", "owner"):
        rows = rows.withColumn(c, F.lit("x"))
    for c in ("open_date", "expected_close_date", "actual_close_date"):
        rows = rows.withColumn(c, F.lit(DAY))
    got = {r["opportunity_id"]: (r["deal_value"], r["deal_value_outlier"]) for r in cleaning.clean_opportunities(rows, leads(spark)).collect()}
    assert got == {"O1": (5e7, False), "O2": (None, True), "O3": (None, False)}


def test_valid_and_rejected_make_up_the_distinct_input(given):
    distinct = given.raw["raw_activities"].select("activity_id").distinct().count()
    assert given.clean["activities_clean"].count() + given.rejected.count() == distinct


def test_repeated_key_is_limited_before_the_shuffle(given):
    plan = cleaning.clean_activities(given.raw["raw_activities"], given.leads)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
