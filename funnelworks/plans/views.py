"""The seven reporting views as DataFrame plans over the star.

Facts are always reduced to the grain of the result before they meet another fact (no fan-out), and windows without
a partition run only on such reduced frames: at most one row per channel, campaign or month.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dbl, mean, n_rows, ratio, rounded, total
from ..model import Star, month_of
from ..schemas import MONTH
from ..session import together



def zero(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def unless_zero(c: str):
    return F.nullif(dbl(c), F.lit(0.0))


class Views:
    """Views over one star, built once per instance."""

    # Views that a build publishes as tables. Lead outcomes hold the only join of two facts; the others are one row
    # per channel, campaign or month, so the questions asked of them do not touch a fact again.
    PUBLISHED = ["lead_outcomes", "channel_performance", "campaign_performance", "monthly_management"]

    def __init__(self, star: Star):
        self.star = star

    def publish(self, table: Callable[..., DataFrame]) -> Views:
        """Write the views worth keeping, each from the ones before, and continue from the written tables; ``table`` writes a
        frame under a name, or knows that it was written before, and gives the table."""

        def keep(name: str, by: str | None = None) -> None:
            self.__dict__[name] = table(name, lambda: getattr(self, name), by)

        keep(self.PUBLISHED[0], "year_month")
        together([partial(keep, name) for name in self.PUBLISHED[1:]])
        return self

    @classmethod
    def published(cls, star: Star, folder: str) -> Views:
        views = cls(star)
        for name in cls.PUBLISHED:  # the plans declare the schemas, so no file is opened for them
            planned = getattr(cls(star), name)
            views.__dict__[name] = star.spark.read.schema(planned.schema).parquet(f"{folder}/{name}").select(*planned.columns)
        return views

    @cached_property
    def lead_outcomes(self) -> DataFrame:
        """V0: one row per lead with what became of it."""
        won = F.col("is_won") == 1
        per_lead = self.star.fact_opportunities.groupBy("lead_id").agg(
            n_rows().alias("n_opportunities"),
            F.max("is_won").alias("any_won"),
            F.sum(F.when(won, F.col("won_value"))).alias("won_sum"),
            mean(F.when(won, F.col("sales_cycle_days"))).alias("won_cycle_days"),
        )
        return (
            self.on_calendar("fact_leads", "created_date_key")
            .join(per_lead, "lead_id", "left")
            .select(
                "lead_id",
                "created_date_key",
                "year_month",
                "channel_id",
                "campaign_id",
                "region_id",
                "company_size",
                "business_type",
                "lead_score",
                "is_mql",
                "is_sql",
                F.when(F.col("n_opportunities") > 0, 1).otherwise(0).alias("has_opportunity"),
                zero("any_won").alias("is_customer"),
                zero("won_sum").cast("decimal(38,2)").alias("won_value"),
                "won_cycle_days",
            )
        )

    def on_calendar(self, fact: str, key: str) -> DataFrame:
        """Rows of a fact with the year_month of the date key it is stored by. The join says that the months are equal too, so
        a condition on the calendar, year_month among it, leaves out months of the fact."""
        days = self.star.dim_date.select(F.col("date_key").alias(key), month_of("date_key").alias(MONTH), "year_month")
        return self.star.by_month(fact).join(days, [key, MONTH])

    def funnel_totals(self, *by: str) -> DataFrame:
        """Lead outcomes added up per group: the common base of the channel and campaign views."""
        return self.lead_outcomes.groupBy(*by).agg(
            n_rows().alias("leads"),
            F.sum("is_mql").alias("mqls"),
            F.sum("is_sql").alias("sqls"),
            F.sum("has_opportunity").alias("opportunities"),
            F.sum("is_customer").alias("customers"),
            total("won_value").alias("won_revenue"),
            mean("lead_score").alias("score_mean"),
            mean("won_cycle_days").alias("cycle_mean"),
        )

    def activity_totals(self, *by: str) -> DataFrame:
        return self.star.fact_marketing_daily.groupBy(*by).agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("sessions").alias("sessions"),
            total("spend").alias("spend"),
        )

    @cached_property
    def channel_performance(self) -> DataFrame:
        """V1: funnel and efficiency per channel. Volumes of a channel without rows stay NULL."""
        everything = Window.partitionBy()
        return (
            self.star.dim_channel.join(self.activity_totals("channel_id"), "channel_id", "left")
            .join(self.funnel_totals("channel_id"), "channel_id", "left")
            .select(
                "channel_id",
                "channel_name",
                "channel_group",
                "is_paid",
                "impressions",
                "clicks",
                "sessions",
                "spend",
                "leads",
                "mqls",
                "sqls",
                "opportunities",
                "customers",
                "won_revenue",
                rounded("score_mean", 1).alias("avg_lead_score"),
                rounded("cycle_mean", 1).alias("avg_sales_cycle_days"),
                rounded(ratio("clicks", "impressions"), 4).alias("ctr"),
                rounded(ratio("spend", "clicks"), 2).alias("cpc"),
                rounded(ratio("leads", "sessions"), 4).alias("session_to_lead_rate"),
                rounded(ratio("sqls", "leads"), 4).alias("lead_to_sql_rate"),
                rounded(ratio("customers", "leads"), 4).alias("lead_to_customer_rate"),
                rounded(ratio(unless_zero("spend"), "leads"), 2).alias("cpl"),
                rounded(ratio(unless_zero("spend"), "customers"), 2).alias("cac"),
                rounded(ratio("won_revenue", "spend"), 2).alias("revenue_to_spend"),
                rounded(ratio("won_revenue", "customers"), 2).alias("avg_deal_value"),
                rounded(
                    ratio("won_revenue", F.sum(F.col("won_revenue").cast("decimal(38,2)")).over(everything)), 4
                ).alias("revenue_share"),
            )
        )

    @cached_property
    def campaign_performance(self) -> DataFrame:
        """V2: zero-filled KPIs per campaign, budget recommendation and revenue rank."""
        siblings = Window.partitionBy("channel_id")
        by_revenue = Window.orderBy(F.col("won_revenue").desc())
        known = self.funnel_totals("campaign_id").where(F.col("campaign_id").isNotNull())
        volumes = ["sessions", "spend", "leads", "mqls", "sqls", "opportunities", "customers", "won_revenue"]
        base = (
            self.star.dim_campaign.join(self.star.dim_channel, "channel_id")
            .join(self.activity_totals("campaign_id"), "campaign_id", "left")
            .join(known, "campaign_id", "left")
            .withColumn("sql_rate", ratio("sqls", "leads"))
            .withColumn("sibling_sql_rate", F.avg("sql_rate").over(siblings))
            .withColumns({v: zero(v) for v in volumes})
        )
        return_on_spend = ratio("won_revenue", "spend")
        advice = (
            F.when(F.col("is_paid") == 0, "NON-PAID")
            .when((return_on_spend >= 1.5) & (F.col("sql_rate") >= F.col("sibling_sql_rate")), "SCALE")
            .when(return_on_spend >= 1.0, "MAINTAIN")
            .when(return_on_spend >= 0.5, "OPTIMISE")
            .otherwise("REDUCE")
        )
        return base.select(
            "campaign_id",
            "campaign_name",
            "channel_name",
            "objective",
            *volumes,
            rounded("score_mean", 1).alias("avg_lead_score"),
            rounded("sql_rate", 4).alias("lead_to_sql_rate"),
            rounded(ratio("customers", "leads"), 4).alias("lead_to_customer_rate"),
            rounded(ratio(unless_zero("spend"), "leads"), 2).alias("cpl"),
            rounded(ratio(unless_zero("spend"), "customers"), 2).alias("cac"),
            rounded(return_on_spend, 2).alias("revenue_to_spend"),
            advice.alias("recommendation"),
            F.dense_rank().over(by_revenue).alias("revenue_rank"),
        )

    @cached_property
    def funnel(self) -> DataFrame:
        """V3: channel x stage. The channel view is unfolded in place, so it is computed once."""
        return funnel_stages(self.channel_performance)

    @cached_property
    def monthly_management(self) -> DataFrame:
        """V4: one row per month of the report period, empty months included."""
        star = self.star
        first, last = star.period
        months = star.dim_date.where(F.col("date_key").between(first, last)).select("year_month").distinct()
        day = star.dim_date.select("date_key", "year_month")
        activity = (
            star.in_months("fact_marketing_daily", first, last)
            .groupBy("date_key")
            .agg(F.sum("sessions").alias("sessions"), F.sum("spend").alias("spend"))
            .join(day, "date_key")
            .groupBy("year_month")
            .agg(F.sum("sessions").alias("sessions"), total("spend").alias("spend"))
        )
        leads = (
            star.in_months("fact_leads", first, last)
            .groupBy(F.col("created_date_key").alias("date_key"))
            .agg(n_rows().alias("leads"), F.sum("is_mql").alias("mqls"), F.sum("is_sql").alias("sqls"))
            .join(day, "date_key")
            .groupBy("year_month")
            .agg(*[F.sum(c).alias(c) for c in ("leads", "mqls", "sqls")])
        )
        won = (
            star.in_months("fact_opportunities", first, last)
            .where("is_won = 1")
            .groupBy(F.coalesce("close_date_key", "created_date_key").alias("date_key"))
            .agg(n_rows().alias("customers"), F.sum("won_value").alias("won_revenue"))
            .join(day, "date_key")
            .groupBy("year_month")
            .agg(F.sum("customers").alias("customers"), total("won_revenue").alias("won_revenue"))
        )
        recurring = star.in_months("fact_customer_monthly", first, last).groupBy("year_month").agg(
            total(F.when(F.col("is_active") == 1, F.col("mrr"))).alias("mrr"),
            F.sum("is_active").alias("active_customers"),
            F.sum("is_churned").alias("churned_customers"),
        )
        joined = months
        for part in (activity, leads, won, recurring):
            joined = joined.join(part, "year_month", "left")
        filled = [
            "sessions", "spend", "leads", "mqls", "sqls", "customers",
            "won_revenue", "mrr", "active_customers", "churned_customers",
        ]
        in_time = Window.orderBy("year_month")
        before = {c: F.lag(c).over(in_time) for c in ("leads", "won_revenue")}
        return joined.select("year_month", *[zero(c).alias(c) for c in filled]).select(
            "*",
            rounded(ratio("spend", "leads"), 2).alias("cpl"),
            rounded(ratio("spend", "customers"), 2).alias("blended_cac"),
            rounded(
                ratio("churned_customers", F.col("active_customers") + F.col("churned_customers")), 4
            ).alias("churn_rate"),
            rounded(ratio(F.col("leads") - before["leads"], before["leads"]), 4).alias("mom_leads"),
            rounded(ratio(F.col("won_revenue") - before["won_revenue"], before["won_revenue"]), 4).alias(
                "mom_revenue"
            ),
        )

    @cached_property
    def opportunity_detail(self) -> DataFrame:
        """V5: one row per opportunity with names and both months. Columns a caller drops cost no join input."""
        star = self.star
        created = star.dim_date.select(
            F.col("date_key").alias("created_date_key"), F.col("year_month").alias("created_month")
        )
        # a closed deal is stored by the month of its close
        closed = star.dim_date.select(
            F.col("date_key").alias("close_date_key"), month_of("date_key").alias(MONTH), F.col("year_month").alias("close_month")
        )
        expected_when = lambda status: F.when(F.col("status") == status, dbl("expected_value")).otherwise(0.0)
        return (
            star.by_month("fact_opportunities")
            .join(star.dim_channel.select("channel_id", "channel_name"), "channel_id")
            .join(star.dim_campaign.select("campaign_id", "campaign_name"), "campaign_id", "left")
            .join(star.dim_region.select("region_id", "region_name"), "region_id")
            .join(created, "created_date_key")
            .join(closed, ["close_date_key", MONTH], "left")
            .select(
                "opportunity_id",
                "channel_name",
                F.coalesce("campaign_name", F.lit("Unassigned")).alias("campaign_name"),
                "region_name",
                "company_size",
                "plan",
                "sites",
                "status",
                "created_month",
                "close_month",
                dbl("expected_value").alias("expected_value"),
                dbl("won_value").alias("won_value"),
                expected_when("Open").alias("open_pipeline_value"),
                expected_when("Lost").alias("lost_value"),
                "sales_cycle_days",
                "value_imputed",
            )
        )

    @cached_property
    def customer_value(self) -> DataFrame:
        """V6: one row per customer with its billing history."""
        star = self.star
        history = star.fact_customer_monthly.groupBy("customer_id").agg(
            n_rows().alias("months_billed"),
            total("mrr").alias("revenue_to_date"),
            F.max("is_churned").alias("has_churned"),
            F.max("year_month").alias("last_month"),
        )
        acquired = star.dim_date.select(
            F.col("date_key").alias("acquisition_date_key"), F.col("year_month").alias("acquisition_month")
        )
        return (
            star.dim_customer.join(star.dim_channel.select("channel_id", "channel_name"), "channel_id")
            .join(star.dim_region, "region_id")
            .join(acquired, "acquisition_date_key")
            .join(history, "customer_id", "left")
            .select(
                "customer_id",
                "channel_name",
                "region_name",
                "region_group",
                "company_size",
                "business_type",
                "plan",
                "acquisition_month",
                dbl("starting_mrr").alias("starting_mrr"),
                "months_billed",
                "revenue_to_date",
                "has_churned",
                "last_month",
            )
        )


STAGE_COLUMNS = [
    ("Sessions", "sessions"),
    ("Leads", "leads"),
    ("MQL", "mqls"),
    ("SQL", "sqls"),
    ("Opportunity", "opportunities"),
    ("Customer", "customers"),
]


def funnel_stages(channel_performance: DataFrame) -> DataFrame:
    """Channel rows to channel x stage rows, each with the step from the stage before."""
    stages = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage_order"),
                F.lit(stage).alias("stage"),
                F.col(column).cast("bigint").alias("volume"),
            )
            for i, (stage, column) in enumerate(STAGE_COLUMNS, 1)
        ]
    )
    previous = F.lag("volume").over(Window.partitionBy("channel_name").orderBy("stage_order"))
    return (
        channel_performance.select("channel_name", F.inline(stages))
        .withColumn("previous_volume", previous)
        .withColumn("kept", ratio("volume", "previous_volume"))
        .select(
            "channel_name",
            "stage_order",
            "stage",
            "volume",
            "previous_volume",
            rounded("kept", 4).alias("conversion_from_previous"),
            rounded(F.lit(1.0) - F.col("kept"), 4).alias("drop_off"),
        )
    )
