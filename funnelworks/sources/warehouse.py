"""Adapter: order-management tables (region nation customer orders lineitem) seen as a marketing funnel.

An order is a lead; an order above the qualification value is an opportunity; a finished one is won. Marketing
activity comes from line items by ship day and part. All money is exact decimal. Each table below is one declarative
plan over the base tables, so a query that needs three columns of one fact reads only what those need.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import calendar_between, date_key
from ..functions.numeric import MONEY, flag
from ..session import sifting, work_dir
from .tables import written

QUALIFIED_ABOVE = 350000

# Known members of the adapter's reference data. Channel 6 and campaign 26 have no activity on purpose. Segments that are
# not listed become channels too, numbered from 7 on; their leads have no campaign.
KNOWN_CHANNELS = """VALUES
  (1, 'AUTOMOBILE', 'Paid Search', 1), (2, 'BUILDING', 'Paid Social', 1), (3, 'FURNITURE', 'Paid Social', 1),
  (4, 'HOUSEHOLD', 'Organic', 0), (5, 'MACHINERY', 'Owned', 0), (6, 'DIRECT', 'Direct', 0)
  AS t(channel_id, channel_name, channel_group, is_paid)"""
CAMPAIGN_COUNT = 26


# Columns read from the base tables. A declared schema saves the footer scan that inference would cost.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
}


class Warehouse:
    """The base tables of one folder and the funnel view of them. Plans are built once and shared."""

    def __init__(self, spark: SparkSession, folder: str, keep_lines: bool = False):
        """keep_lines: the lines of qualified orders are written once, for jobs that need them several times."""
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.keep_lines = keep_lines

    @cache  # noqa: B019 - a warehouse lives as long as its session
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # ---- dimensions
    @cache  # noqa: B019
    def months(self) -> DataFrame:
        """One row: the first day of the first month and the last day of the last month with an order or a shipment."""
        days = [
            self.table(t).agg(F.min(c).alias("low"), F.max(c).alias("high"))
            for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
        ]
        both = days[0].unionByName(days[1]).agg(F.min("low").alias("low"), F.max("high").alias("high"))
        return both.select(F.trunc("low", "MM").alias("first"), F.last_day("high").alias("last"))

    @cache  # noqa: B019
    def period(self) -> tuple[int, int]:
        """The months of the data as inclusive date keys."""
        row = self.months().select(date_key("first"), date_key("last")).first()
        return row[0] or 0, row[1] or 0

    @cache  # noqa: B019
    def days(self) -> DataFrame:
        """Bounds of the calendar: the months of the data and one more on either side."""
        return self.months().select(
            F.add_months("first", -1).alias("first"), F.last_day(F.add_months("last", 1)).alias("last")
        )

    @cache  # noqa: B019
    def dim_date(self) -> DataFrame:
        return calendar_between(self.days())

    @cache  # noqa: B019
    def dim_channel(self) -> DataFrame:
        known = self.spark.sql(f"SELECT * FROM {KNOWN_CHANNELS}")
        segment = F.col("c_mktsegment").alias("channel_name")
        other = self.table("customer").select(segment).distinct().join(known, "channel_name", "left_anti")
        rank = F.row_number().over(Window.orderBy("channel_name"))  # over segments, not over customers
        other = other.where("channel_name IS NOT NULL").select(
            (rank + 6).cast("int").alias("channel_id"), "channel_name", F.lit("Other").alias("channel_group"), F.lit(0).alias("is_paid")
        )
        return known.unionByName(other)

    @cache  # noqa: B019
    def dim_campaign(self) -> DataFrame:
        i = F.col("id").cast("int")
        return self.spark.range(1, CAMPAIGN_COUNT + 1, 1, 1).select(
            i.alias("campaign_id"),
            F.concat(F.lit("Campaign "), F.lpad(i.cast("string"), 2, "0")).alias("campaign_name"),
            F.expr("CAST((id - 1) div 5 + 1 AS int)").alias("channel_id"),
            F.when(i % 3 == 0, "Awareness").when(i % 3 == 1, "Leads").otherwise("Retargeting").alias("objective"),
            F.to_date(F.lit("1995-01-01")).alias("start_date"),
        )

    @cache  # noqa: B019
    def dim_region(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("int").alias("region_id"),
            F.col("n_name").alias("region_name"),
            F.col("r_name").alias("region_group"),
        )

    # ---- shared derivations, also the starting point of the raw exports
    @cache  # noqa: B019
    def lead_base(self) -> DataFrame:
        """Orders with the attributes of their customer, before any cleaning rule."""
        orders = self.table("orders")
        customer = self.table("customer")
        band = F.pmod("c_custkey", F.lit(10))
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(self.dim_channel(), F.col("c_mktsegment") == F.col("channel_name"), "left")
            .select(
                F.col("o_orderkey").alias("lead_id"),
                F.col("o_orderdate").cast("date").alias("created"),
                "channel_id",
                "channel_name",
                F.when(
                    (F.pmod("o_orderkey", F.lit(100)) != 0) & (F.col("channel_id") <= 5),
                    _campaign_of("channel_id", "c_custkey"),
                ).alias("campaign_id"),
                F.col("c_nationkey").cast("int").alias("region_id"),
                F.when(band <= 5, "1-9").when(band <= 8, "10-49").otherwise("50+").alias("company_size"),
                F.col("o_orderpriority").alias("business_type"),
                F.floor(F.col("c_acctbal") / 100).cast("int").alias("lead_score"),
                F.substring("o_orderpriority", 1, 1).isin("1", "2", "3").cast("int").alias("is_mql"),
                flag(F.col("o_totalprice") > QUALIFIED_ABOVE).alias("is_sql"),
            )
        )

    def qualified_orders(self) -> DataFrame:
        return self.table("orders").where(F.col("o_totalprice") > QUALIFIED_ABOVE)

    @cache  # noqa: B019
    def order_lines(self) -> DataFrame:
        """Lines of at least the qualified orders; deals and billing need no others. If they are to be kept, most other lines
        are left out before the shuffle of the one join that finds them."""
        if not self.keep_lines:
            return self.table("lineitem")
        path = work_dir(self.spark, "lines")
        kept = written(self.qualified_line_plan(), path)
        return self.spark.read.schema(kept.schema).parquet(path)

    def qualified_line_plan(self) -> DataFrame:
        """The lines of qualified orders, in a session that sifts."""
        there = Warehouse(sifting(self.spark), self.folder)
        wanted = there.qualified_orders().select(F.col("o_orderkey").alias("l_orderkey"))
        lines = there.table("lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
        return lines.join(wanted, "l_orderkey", "left_semi")

    @cache  # noqa: B019
    def opportunity_base(self) -> DataFrame:
        """Qualified orders with the value and last ship day of their lines, before any cleaning rule.

        Every 200th order belongs to the lead before it, so some leads have two opportunities.
        """
        value = F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
        lines = (
            self.order_lines()
            .groupBy("l_orderkey")
            .agg(F.sum(value).cast(MONEY).alias("line_value"), F.max("l_shipdate").cast("date").alias("last_ship"))
        )
        orders = self.qualified_orders()
        key = F.col("o_orderkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", "Won").when(F.col("o_orderstatus") == "P", "Lost").otherwise("Open")
        )
        return orders.join(lines, key == F.col("l_orderkey"), "left").select(
            key.alias("opportunity_id"),
            F.when(F.pmod(key, F.lit(200)) == 1, key - 1).otherwise(key).alias("lead_id"),
            F.col("o_orderdate").cast("date").alias("created"),
            F.when(status != "Open", F.col("last_ship")).alias("closed"),
            status.alias("status"),
            F.element_at(F.array(F.lit("Starter"), F.lit("Pro"), F.lit("Group")), (key % 3 + 1).cast("int")).alias(
                "plan"
            ),
            (key % 5 + 1).cast("int").alias("sites"),
            F.col("o_totalprice").cast(MONEY).alias("expected_value"),
            F.when(status == "Won", F.coalesce("line_value", F.lit(0).cast(MONEY)))
            .otherwise(F.lit(0).cast(MONEY))
            .alias("won_value"),
        )

    def billing_base(self, customers: DataFrame) -> DataFrame:
        """(customer, month) amounts from the lines of the given qualified orders; churned in a last month with a return.

        Lines of other orders are dropped first, by the order key, by which the window is partitioned too.
        """
        month = F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM")
        cents = (F.sum(F.col("l_extendedprice").cast(MONEY)) * 100).cast("bigint")
        by_month = (
            self.order_lines()
            .join(customers.select(F.col("customer_id").alias("l_orderkey")), "l_orderkey", "left_semi")
            .groupBy(F.col("l_orderkey").alias("customer_id"), month.alias("year_month"))
            .agg(twelfth(cents).alias("mrr"), F.max(F.col("l_returnflag") == "R").alias("returned"))
        )
        last = F.max("year_month").over(Window.partitionBy("customer_id"))
        return by_month.withColumn("last_month", last).select(
            "customer_id",
            "year_month",
            "mrr",
            F.when(F.col("returned") & (F.col("year_month") == F.col("last_month")), "churned")
            .otherwise("active")
            .alias("status"),
        )

    @cache  # noqa: B019
    def marketing_base(self) -> DataFrame:
        """Daily activity per campaign: one scan of the line items, reduced before the shuffle."""
        campaign = (F.pmod("l_partkey", F.lit(25)) + 1).cast("int")
        cost = F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)")
        factor = (F.pmod("campaign_id", F.lit(5)) + 1).cast("decimal(4,2)") * F.lit(0.75).cast("decimal(4,2)")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_shipdate").cast("date").alias("day"), campaign.alias("campaign_id"))
            .agg(
                F.sum(F.col("l_quantity").cast("bigint")).alias("clicks"),
                F.count(F.lit(1)).alias("sessions"),
                F.sum(cost).cast(MONEY).alias("cost"),
            )
            .withColumn("channel_id", F.expr("CAST((campaign_id - 1) div 5 + 1 AS int)"))
            .select(
                "day",
                "campaign_id",
                "channel_id",
                (F.col("clicks") * 20).alias("impressions"),
                "clicks",
                "sessions",
                F.when(F.col("channel_id") <= 3, (F.col("cost") * factor).cast(MONEY))
                .otherwise(F.lit(0).cast(MONEY))
                .alias("spend"),
            )
        )


def twelfth(cents: Column) -> Column:
    """A twelfth of an amount in cents, as money, rounded half up in integers."""
    return (F.floor((cents * 2 + 12) / 24) / 100).cast(MONEY)


def _campaign_of(channel: str, customer: str) -> Column:
    return ((F.col(channel) - 1) * 5 + F.pmod(customer, F.lit(5)) + 1).cast("int")
