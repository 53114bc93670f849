import datetime as dt

import pytest

from dealgauge.plans import reports


@pytest.fixture(scope="module")
def rows(spark):
    day = dt.date
    data = [
        ("L1", "Acme", "New", "EU", 10.0, day(2020, 1, 5), None, True, None, "Treatment", 2),
        ("L2", "Bolt", "Contacted", "EU", 0.0, day(2020, 2, 5), "Closed-Won", True, "Opened", "Control", 2),
        ("L3", None, "Converted", "US", 30.0, day(2021, 1, 5), "Closed-Won", True, "None", "Treatment", 4),
        ("L4", "acme 2", "Lost", "US", 0.0, day(2021, 4, 5), None, False, None, None, 4),
        ("L5", "Core", "Other", None, 5.0, day(2021, 4, 6), None, False, None, None, 9),
    ]
    frame = spark.createDataFrame(
        data, "lead_id string, company_name string, status string, region string, deal_value double, created_date date, "
        "opportunity_stage string, received_campaign boolean, campaign_response string, treatment_group string, total_activities long")
    return frame.selectExpr("*", "cast(total_activities as int) * 10 as duration_days", "'s' as lead_source", "'i' as industry")


def test_search_is_a_regex_in_any_case_and_null_never_matches(rows):
    assert [r["lead_id"] for r in reports.search(rows, "^ACME|l5").orderBy("lead_id").collect()] == ["L1", "L4", "L5"]


def test_empty_selection_is_no_filter(rows):
    assert reports.keep_selected(rows, {"region": [], "status": []}).count() == 5
    assert reports.keep_selected(rows, {"region": ["EU"], "status": ["New", "Lost"]}).count() == 1


def test_kpis_of_nothing_are_zero(rows):
    row = reports.customer_kpis(rows.filter("false")).first()
    assert (row["total_customers"], row["conversion_rate"], row["pipeline_value"]) == (0, 0.0, 0.0)


def test_funnel_counts_reached_stages_without_exits(rows):
    got = [(r["stage"], r["leads"], r["dropoff_pct"]) for r in reports.funnel(rows).orderBy("step").collect()]
    assert got == [("New", 3, 0.0), ("Contacted", 2, 33.3), ("Qualified", 1, 50.0), ("Converted", 1, 0.0)]


def test_months_are_in_time_order(rows):
    got = [r["month"] for r in reports.monthly_trend(rows, 3).collect()]
    assert got == ["Feb 2020", "Jan 2021", "Apr 2021"]


def test_proxy_risk(rows):
    got = {r["lead_id"]: r for r in reports.proxy_risk(rows).collect()}
    # ranks of activities: 2,2,4,4,9 -> .3 .3 .7 .7 1; durations follow them
    assert got["L1"]["risk_score"] == pytest.approx(0.45 * 0.55 + 0.2 * 0.7 + 0.2 * 0.3 + 0.15)
    assert got["L2"]["risk_score"] == pytest.approx(0.45 * 0.45 + 0.2 * 0.7 + 0.2 * 0.3)
    assert got["L3"]["risk_score"] == pytest.approx(0.45 * 0.10 + 0.2 * 0.3 + 0.2 * 0.7 + 0.15)
    assert got["L5"]["risk_score"] == pytest.approx(0.45 * 0.5 + 0.2 * 1.0)
    assert got["L2"]["exposure"] == pytest.approx(15.0) and got["L4"]["risk_tier"] == "Medium"


def test_intervention_with_an_absent_arm(rows):
    effect = reports.intervention_effect(reports.intervention_summary(rows.filter("treatment_group = 'Treatment'"))).first()
    assert (effect["treatment_leads"], effect["control_rate"], effect["uplift_pp"]) == (2, 0.0, 50.0)
    assert effect["additional_conversions"] == 1.0


def test_uplift_needs_both_arms(rows):
    assert reports.uplift_by_source(rows).count() == 1
    assert reports.uplift_by_source(rows.filter("treatment_group = 'Control'")).count() == 0


def test_histogram_closes_the_last_bin(rows):
    got = {r["bin"]: r["leads"] for r in reports.histogram(rows, "total_activities", 7).collect()}
    assert got == {0: 2, 2: 2, 6: 1}
    assert reports.histogram(rows.filter("lead_id = 'L1'"), "total_activities", 7).first()["bin"] == 0


def test_filter_values_skip_null(rows):
    got = [(r[0], r[1]) for r in reports.filter_values(rows, ["region", "treatment_group"]).collect()]
    assert got == [("region", "EU"), ("region", "US"), ("treatment_group", "Control"), ("treatment_group", "Treatment")]
