"""The four raw lead tables as views over customer, orders, nation, region and events.

A customer is a lead; its first order, for six customers in ten, is the lead's opportunity; an
event is an activity; 45 % of the customers got one campaign touch. Values that the source tables
do not carry are derived from the keys, and a fixed part of the rows is made dirty (missing and
textual sizes, outliers, orphans, repeated activities) so that cleaning has something to do.
The rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORPHAN_LEAD = "L99999999"

# The category values of the reference's data, of which its reports show sources, stages and responses by name
# and its models take the first in the alphabet as baseline.
LEAD_SOURCES = ["Website", "Referral", "Cold Call", "LinkedIn", "Trade Show", "Webinar"]
JOB_TITLES = ["VP Sales", "Marketing Manager", "CEO", "Procurement Lead", "Operations Director", "IT Manager"]
OPEN_STAGES = ["Prospecting", "Qualification", "Proposal", "Negotiation"]
CHANNELS = ["Email", "Phone", "LinkedIn", "In-person"]
OUTCOMES = ["Positive", "Neutral", "Negative", "No Response"]
RESPONSES = ["Opened", "Clicked", "Replied", "Unsubscribed", "No Action"]
EARLY_STATUSES = ["New", "Contacted", "Unqualified"]

_TWO32 = 1 << 32


def mix(key: Column, multiplier: int, buckets: int) -> Column:
    """((key + 1) * multiplier mod 2^32) div 65536 mod buckets, without 64-bit overflow.

    The key is reduced first and multiplied in two 16-bit halves, so any bigint key is safe.
    """
    low32 = F.pmod(key + 1, F.lit(_TWO32))
    high = F.shiftright(low32, 16) * F.lit(multiplier)
    low = low32.bitwiseAND(F.lit(65535)) * F.lit(multiplier)
    product = F.pmod(F.pmod(high, F.lit(65536)) * 65536 + low, F.lit(_TWO32))
    return F.pmod(F.shiftright(product, 16), F.lit(buckets)).cast("int")


def pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _tagged(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


class OrderBook:
    """Raw tables for one folder of Parquet files. Every method returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")

    def _read(self, table: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{table}.parquet")

    def lead_count(self) -> int:
        """Answered from the file footers."""
        return self._read("customer").count()

    def first_orders(self) -> DataFrame:
        """First order of each customer that has an opportunity.

        ``min`` over a struct is combined on the map side, so a customer with very many orders
        sends one row per task. All three users below share this plan and so its exchange.
        """
        orders = self._read("orders").filter(mix(F.col("o_custkey"), 374761393, 10) < 6)
        first = F.min(F.struct(
            F.col("o_orderdate").alias("order_date"), F.col("o_orderkey").alias("order_key"),
            F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").alias("total_price"),
        ))
        return orders.groupBy("o_custkey").agg(first.alias("f")).select(
            "o_custkey", F.col("f.order_date").cast("date").alias("order_date"),
            "f.order_key", "f.order_status", "f.total_price")

    def _customers(self) -> DataFrame:
        customers = self._read("customer")
        firsts = self.first_orders()
        k = F.col("c_custkey")
        return customers.join(firsts, customers["c_custkey"] == firsts["o_custkey"], "left").withColumn(
            "created_date",
            F.date_sub(F.coalesce("order_date", F.lit("1998-01-01").cast("date")), mix(k, 461845907, 120)),
        )

    def raw_leads(self) -> DataFrame:
        k = F.col("c_custkey")
        size = (F.floor(F.abs("c_acctbal") / 10) + 5).cast("int").cast("string")
        damage = mix(k, 2246822519, 100)
        nations = self._read("nation").join(
            self._read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self._customers()
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _tagged("L", k).alias("lead_id"),
                _tagged("Contact ", k).alias("contact_name"),
                F.col("c_name").alias("company_name"),
                F.col("c_mktsegment").alias("industry"),
                F.when(mix(k, 2654435761, 50) == 0, None)
                .when(damage == 1, F.concat(size, F.lit(" emp")))
                .when(damage == 2, F.concat(size, F.lit(".0")))
                .otherwise(size)
                .alias("company_size"),
                pick(mix(k, 3266489917, 6), LEAD_SOURCES).alias("lead_source"),
                pick(mix(k, 668265263, 6), JOB_TITLES).alias("job_title"),
                F.col("n_name").alias("country"),
                F.col("r_name").alias("region"),
                F.when(F.col("order_status") == "F", "Converted")
                .when(F.col("order_status") == "P", "Lost")
                .when(F.col("order_status") == "O", "Qualified")
                .otherwise(pick(mix(k, 374761393, 3), EARLY_STATUSES))
                .alias("status"),
                "created_date",
            )
        )

    def raw_opportunities(self) -> DataFrame:
        ok, opened = F.col("order_key"), F.col("order_date")
        closed_lag = 10 + mix(ok, 374761393, 71) + mix(ok, 3432918353, 31)
        return self.first_orders().select(
            _tagged("O", ok).alias("opportunity_id"),
            F.when(mix(ok, 2246822519, 200) == 0, ORPHAN_LEAD).otherwise(_tagged("L", F.col("o_custkey"))).alias("lead_id"),
            F.when(mix(ok, 3266489917, 300) == 0, 999999999.0)
            .when(mix(ok, 2654435761, 40) == 0, None)
            .otherwise(F.col("total_price"))
            .alias("deal_value"),
            F.when(F.col("order_status") == "F", "Closed-Won")
            .when(F.col("order_status") == "P", "Closed-Lost")
            .otherwise(pick(mix(ok, 668265263, 4), OPEN_STAGES))
            .alias("stage"),
            _tagged("Owner ", F.pmod("o_custkey", F.lit(20))).alias("owner"),
            opened.alias("open_date"),
            F.date_add(opened, 20 + mix(ok, 374761393, 71)).alias("expected_close_date"),
            F.when(F.col("order_status") == "O", None)
            .when(mix(ok, 461845907, 97) == 0, F.date_sub(opened, 200))
            .otherwise(F.date_add(opened, closed_lag))
            .alias("actual_close_date"),
        )

    def raw_activities(self) -> DataFrame:
        """One scan: a repeated event is exploded into two copies instead of being unioned."""
        e = F.col("event_id")
        copies = F.when(F.pmod(e, F.lit(100)) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        orphan = (F.pmod(e, F.lit(200)) == 0) | ((F.col("copy") == 1) & (F.pmod(e, F.lit(1000)) == 103))
        return (
            self._read("events")
            .select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("activity_date"),
                    F.explode(copies).alias("copy"))
            .select(
                _tagged("T", e).alias("activity_id"),
                F.when(orphan, ORPHAN_LEAD)
                .otherwise(_tagged("L", F.col("user_id") * 10 + F.pmod(e, F.lit(10))))
                .alias("lead_id"),
                "activity_date",
                F.col("event_type").alias("activity_type"),
                pick(F.pmod(e, F.lit(4)).cast("int"), CHANNELS).alias("channel"),
                pick(F.pmod(F.floor(e / 4), F.lit(4)).cast("int"), OUTCOMES).alias("outcome"),
                (e * 2 + F.col("copy")).alias("ingest_seq"),
            )
        )

    def raw_campaign_touches(self) -> DataFrame:
        k = F.col("c_custkey")
        return self._customers().filter(mix(k, 1540483477, 20) < 9).select(
            _tagged("P", k).alias("touch_id"),
            _tagged("L", k).alias("lead_id"),
            F.lit("CMP001").alias("campaign_id"),
            F.date_add("created_date", (5 + F.pmod(k, F.lit(26))).cast("int")).alias("touch_date"),
            pick(mix(k, 3432918353, 5), RESPONSES).alias("response"),
            F.when(mix(k, 2870177451, 2) == 0, "Treatment").otherwise("Control").alias("treatment_group"),
            k.alias("ingest_seq"),
        )
