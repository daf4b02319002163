"""Raw exports with faults, derived row by row from the warehouse tables.

The warehouse has no label noise, bad dates or repeated exports of its own. They are added here by fixed rules on the
business keys (every n-th row), so each cleaning rule has hits, near misses and untouched rows at every size.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.numeric import MONEY
from ..model import Exports, Reference
from ..operators.dedupe import POSITION
from .warehouse import Warehouse, twelfth

NBSP = " "


def _every(key: Column, n: int, offset: int) -> Column:
    return F.pmod(key, F.lit(n)) == offset


def _copies(df: DataFrame, *extra: Column) -> DataFrame:
    """Adds ``copy``: 0 for the row itself, i for the i-th repeated export where its condition holds."""
    wanted = [F.lit(0), *[F.when(cond, F.lit(i)) for i, cond in enumerate(extra, 1)]]
    return df.withColumn("copy", F.explode(F.array_compact(F.array(*wanted))))


def _iso(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


class MessyExports:
    """The five exports and the reference data they are matched to."""

    def __init__(self, warehouse: Warehouse):
        self.w = warehouse

    @cache  # noqa: B019
    def marketing(self) -> DataFrame:
        base = self.w.marketing_base().withColumn("k", date_key("day") + F.col("campaign_id") * 7)
        k = F.col("k")
        campaigns = self.w.dim_campaign().select("campaign_id", "campaign_name")
        channels = self.w.dim_channel().select("channel_id", "channel_name")
        date = (
            F.when(_every(k, 211, 5), F.concat(F.year("day").cast("string"), F.lit("-06-31")))
            .when(_every(k, 211, 9), None)
            .when(_every(k, 211, 17), F.date_format("day", "yyyy-M-d"))
            .otherwise(_iso("day"))
        )
        channel = (
            F.when(_every(k, 50, 7), F.concat(F.lower("channel_name"), F.lit(" ")))
            .when(_every(k, 50, 11), F.concat(F.lit(NBSP), F.col("channel_name")))
            .otherwise(F.col("channel_name"))
        )
        spend = (
            F.when(_every(k, 101, 2), -F.col("spend"))
            .when(_every(k, 307, 4), F.col("spend") * 64)
            .otherwise(F.col("spend"))
        )
        rows = _copies(
            base.join(campaigns, "campaign_id").join(channels, "channel_id"), _every(k, 97, 3), _every(k, 113, 8)
        )
        return rows.select(
            date.alias("date"),
            channel.alias("channel"),
            F.col("campaign_name").alias("campaign"),
            "impressions",
            F.when(_every(k, 89, 6), F.col("impressions") + 25).otherwise(F.col("clicks")).alias("clicks"),
            "sessions",
            (spend + F.when(F.col("copy") == 2, 1).otherwise(0)).cast(MONEY).alias("spend"),
            (date_key("day").cast("bigint") * 1000 + F.col("campaign_id") * 10 + F.col("copy")).alias(POSITION),
        )

    @cache  # noqa: B019
    def leads(self) -> DataFrame:
        k = F.col("lead_id")
        campaigns = self.w.dim_campaign().select("campaign_id", "campaign_name")
        regions = self.w.dim_region().select("region_id", "region_name")
        clock = F.concat(
            F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0")
        )
        channel = (
            F.when(_every(k, 50, 7), F.concat(F.lower("channel_name"), F.lit(" ")))
            .when(_every(k, 50, 11), F.concat(F.lit("  "), F.col("channel_name")))
            .otherwise(F.col("channel_name"))
        )
        campaign = F.when(
            _every(k, 45, 4), F.replace(F.upper("campaign_name"), F.lit(" "), F.lit(NBSP + " "))
        ).otherwise(F.col("campaign_name"))
        region = (
            F.when(_every(k, 40, 3), F.concat(F.lower("region_name"), F.lit(" ")))
            .when(_every(k, 40, 5), F.concat(F.lit("Land "), F.col("region_id").cast("string")))
            .otherwise(F.col("region_name"))
        )
        size = F.when(
            _every(k, 30, 4),
            F.replace(F.replace(F.col("company_size"), F.lit("-"), F.lit(" - ")), F.lit("+"), F.lit(" +")),
        ).otherwise(F.col("company_size"))
        score = (
            F.when(_every(k, 500, 9), None)
            .when(_every(k, 500, 11), F.lit(4321.0))
            .otherwise(F.col("lead_score").cast("double"))
        )
        rows = _copies(
            self.w.lead_base().join(campaigns, "campaign_id", "left").join(regions, "region_id"), _every(k, 61, 2)
        )
        return rows.select(
            F.when(~_every(k, 331, 7), k).alias("lead_id"),
            F.concat(_iso("created"), F.lit(" "), clock).alias("created_at"),
            channel.alias("channel"),
            F.coalesce(campaign, F.lit("Untracked push")).alias("campaign"),
            region.alias("region"),
            size.alias("company_size"),
            "business_type",
            (score + F.col("copy")).alias("lead_score"),
            "is_mql",
            "is_sql",
            (k * 10 + F.col("copy")).alias(POSITION),
        )

    @cache  # noqa: B019
    def opportunities(self) -> DataFrame:
        k = F.col("opportunity_id")
        stage = (
            F.when(_every(k, 20, 1), F.lower("status"))
            .when(_every(k, 20, 2), F.upper("status"))
            .when(_every(k, 90, 3), F.concat(F.col("status"), F.lit(" ")))
            .otherwise(F.col("status"))
        )
        won = (
            F.when(_every(k, 53, 5), F.lit(0).cast(MONEY))
            .when(_every(k, 53, 6) & (F.col("status") == "Won"), None)
            .when(_every(k, 59, 7), -F.col("won_value"))
            .otherwise(F.col("won_value"))
        )
        rows = _copies(self.w.opportunity_base(), _every(k, 71, 3))
        return rows.select(
            "opportunity_id",
            F.when(_every(k, 401, 6), -k).otherwise(F.col("lead_id")).alias("lead_id"),
            _iso("created").alias("created_at"),
            _iso("closed").alias("closed_at"),
            stage.alias("stage"),
            "plan",
            "sites",
            "expected_value",
            won.alias("won_value"),
            (k * 10 + F.col("copy")).alias(POSITION),
        )

    def _billed(self) -> DataFrame:
        """Won opportunities, plus a few lost ones that were billed by mistake."""
        lost = (F.col("status") == "Lost") & _every(F.col("opportunity_id"), 89, 4)
        return self.w.opportunity_base().where((F.col("status") == "Won") | lost)

    @cache  # noqa: B019
    def customers(self) -> DataFrame:
        k = F.col("opportunity_id")
        start = F.when(F.col("closed") >= F.col("created"), F.col("closed")).otherwise(F.col("created"))
        value = F.when(F.col("won_value") > 0, F.col("won_value")).otherwise(F.col("expected_value"))
        rows = _copies(self._billed(), _every(k, 67, 1))
        return rows.select(
            k.alias("customer_id"),
            k.alias("opportunity_id"),
            _iso(start).alias("start_date"),
            "plan",
            (twelfth((value * 100).cast("bigint")) + F.col("copy")).cast(MONEY).alias("starting_mrr"),
            (k * 10 + F.col("copy")).alias(POSITION),
        )

    @cache  # noqa: B019
    def customer_monthly(self) -> DataFrame:
        k = F.col("customer_id")
        billed = self._billed().select(F.col("opportunity_id").alias("customer_id"))
        rows = _copies(self.w.billing_base(billed), _every(k, 43, 2))
        return rows.select(
            "customer_id",
            "year_month",
            (F.col("mrr") + F.col("copy")).cast(MONEY).alias("mrr"),
            "status",
            ((k * 1_000_000 + F.replace(F.col("year_month"), F.lit("-"), F.lit("")).cast("int")) * 10 + F.col("copy")).alias(
                POSITION
            ),
        )

    def exports(self) -> Exports:
        return Exports({name: getattr(self, name) for name in Exports.names})

    def reference(self) -> Reference:
        regions = self.w.dim_region()
        synonyms = lambda: regions.select(
            F.concat(F.lit("Land "), F.col("region_id").cast("string")).alias("label"),
            F.col("region_name").alias("name"),
        )
        return Reference(
            {
                "channels": self.w.dim_channel,
                "campaigns": self.w.dim_campaign,
                "regions": lambda: regions,
                "synonyms": synonyms,
            }
        )
