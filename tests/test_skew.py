"""One customer, one lead and one activity id hold about a third of the rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from check_sql import connect, difference

from given_tables import TESTDATA

QUERIES = [
    "silver_leads", "silver_opportunities", "silver_activities", "activities_rejected", "lead_summary", "pk_violations",
    "cleaning_report", "proxy_risk", "clv", "qini_curve", "country_metrics", "concordance",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))

    def given(table):
        return spark.read.parquet(f"{TESTDATA}/{table}.parquet")

    for table in ("nation", "region", "customer"):
        given(table).write.parquet(f"{folder}/{table}.parquet")
    hot_customer = F.when(F.col("o_orderkey") % 3 == 0, 5).otherwise(F.col("o_custkey"))
    given("orders").withColumn("o_custkey", hot_customer.cast("long")).write.parquet(f"{folder}/orders.parquet")
    # a third of the events are one user's, and one event is there 500 times more
    hot_user = F.when(F.col("event_id") % 3 == 0, 3).otherwise(F.col("user_id"))
    events = given("events").withColumn("user_id", hot_user.cast("long"))
    repeated = events.filter("event_id = 7").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    events.unionByName(repeated).write.parquet(f"{folder}/events.parquet")
    return folder, connect(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, skewed, name):
    folder, duck = skewed
    expected = duck.sql(entry_points.oracle_sql()[name]).to_arrow_table()
    assert difference(entry_points.queries()[name](spark, folder).toArrow(), expected) is None
