import datetime as dt

from pyspark.sql import functions as F

from dealgauge.operators import star


def test_calendar(spark):
    days = star.calendar(spark, dt.date(2010, 1, 1), dt.date(2026, 12, 31))
    assert days.count() == 6209
    row = days.filter(F.col("date_id") == dt.date(2023, 5, 7)).first()
    assert row["month_name"] == "May      " and row["day_name"] == "Sunday   "
    assert (row["day_of_week"], row["is_weekend"], row["quarter"]) == (0, True, 2)


def summary(spark):
    day = dt.date
    leads = spark.createDataFrame(
        [("L1", "Converted", day(2020, 1, 1)), ("L2", "Converted", day(2020, 1, 1)), ("L3", "New", day(2026, 9, 7))],
        "lead_id string, status string, created_date date")
    for c in ("contact_name", "company_name", "industry", "lead_source", "job_title", "country", "region"):
        leads = leads.withColumn(c, F.lit("x"))
    leads = leads.withColumn("company_size", F.lit(None).cast("int")).withColumn("company_size_missing", F.lit(True))
    opportunities = spark.createDataFrame(
        [("O1", "L1", 10.0, day(2020, 1, 11)), ("O9", "L9", 10.0, day(2020, 1, 11))],
        "opportunity_id string, lead_id string, deal_value double, actual_close_date date",
    ).withColumns({
        "deal_value_outlier": F.lit(False), "stage": F.lit("Closed-Won"), "open_date": F.lit(day(2020, 1, 1)),
        "expected_close_date": F.lit(day(2020, 1, 1))})
    activities = spark.createDataFrame(
        [("T1", "L1", day(2020, 1, 3)), ("T2", "L1", day(2020, 1, 2)), ("T3", "L9", day(2020, 1, 2))],
        "activity_id string, lead_id string, activity_date date")
    touches = spark.createDataFrame(
        [("P1", "L2", day(2020, 1, 3), None, "Treatment")],
        "touch_id string, lead_id string, touch_date date, response string, treatment_group string")
    return star.lead_summary(leads, activities, opportunities, touches, day(2026, 9, 6))


def test_lead_summary(spark):
    rows = {r["lead_id"]: r for r in summary(spark).collect()}
    assert set(rows) == {"L1", "L2", "L3"}
    assert (rows["L1"]["event_converted"], rows["L1"]["duration_days"], rows["L1"]["total_activities"]) == (1, 10, 2)
    assert rows["L1"]["first_activity_date"] == dt.date(2020, 1, 2) and rows["L1"]["has_opportunity"]
    # converted without a close date: an event with the snapshot duration
    assert (rows["L2"]["event_converted"], rows["L2"]["duration_days"]) == (1, 2440)
    assert rows["L2"]["received_campaign"] and rows["L2"]["total_activities"] == 0
    assert (rows["L3"]["duration_days"], rows["L3"]["received_campaign"]) == (-1, False)


def test_survival_input_keeps_positive_durations(spark):
    rows = star.survival_input(summary(spark)).collect()
    assert sorted((r["lead_id"], r["received_campaign"]) for r in rows) == [("L1", 0), ("L2", 1)]
