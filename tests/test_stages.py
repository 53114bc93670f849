import dataclasses

from dealgauge.operators import clv, star
from dealgauge.plans import reports
from dealgauge.plans.workspace import GIVEN_TABLES, Workspace
from dealgauge.sources.stages import measured

from given_tables import TESTDATA


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_measured_rows_are_broadcast_by_size(spark):
    big = spark.range(100_000).selectExpr("id % 7 as g", "id")
    rates = big.groupBy("g").count()
    assert "SortMergeJoin" in plan_of(big.join(rates, "g")) or "Exchange hashpartitioning" in plan_of(big.join(rates, "g"))
    joined = big.join(measured(rates), "g")
    assert "BroadcastHashJoin" in plan_of(joined) and "hashpartitioning" not in plan_of(joined)


def test_bucketed_stages_join_without_a_shuffle(spark, given):
    bucketed = Workspace(spark, TESTDATA, dataclasses.replace(GIVEN_TABLES, rows_per_bucket=40))
    assert bucketed.summary.exceptAll(given.summary).count() == 0 and bucketed.summary.count() == given.summary.count()
    assert bucketed.rule_outputs.exceptAll(given.rule_outputs).count() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = plan_of(star.scored_summary(bucketed.summary, bucketed.rule_outputs))
        assert "SortMergeJoin" in scored and "Exchange" not in scored
        # only the activities are shuffled, to count them per lead
        summary = plan_of(star.lead_summary(
            bucketed.leads, bucketed.activities, bucketed.opportunities, bucketed.touches, GIVEN_TABLES.snapshot))
        assert summary.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    detail = reports.clv_detail(clv.with_value_tier(bucketed.values.drop("clv_tier")), bucketed.rule_outputs, bucketed.summary)
    assert detail.count() == bucketed.summary.count()
    bucketed.stages.drop_tables()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stage_")]
