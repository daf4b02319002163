"""The 14 integrity tests: (test_name, failures), every one must be 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import count_where, n_rows, rounded
from ..operators.rows import anti_count, rows_of, union_all
from .views import Views


def _counts(frame: DataFrame, tests: dict[str, Column]) -> DataFrame:
    counted = frame.agg(*[count_where(cond).alias(name) for name, cond in tests.items()])
    return rows_of(counted, test_name=[F.lit(t) for t in tests], failures=[F.col(t) for t in tests])


def _named(name: str, one_row: DataFrame) -> DataFrame:
    return one_row.select(F.lit(name).alias("test_name"), F.col("n").cast("bigint").alias("failures"))


def integrity_tests(v: Views) -> DataFrame:
    s = v.star
    c = F.col
    leads, deals, customers = s.fact_leads, s.fact_opportunities, s.dim_customer
    won = deals.where("is_won = 1")
    missing_ids = [
        leads.agg(count_where(c("lead_id").isNull()).alias("n")),
        deals.agg(count_where(c("opportunity_id").isNull() | c("lead_id").isNull()).alias("n")),
        customers.agg(count_where(c("customer_id").isNull() | c("opportunity_id").isNull()).alias("n")),
    ]
    by_channel = v.channel_performance
    view_totals = by_channel.agg(F.sum("leads").alias("l"), F.sum(c("spend").cast("decimal(38,2)")).alias("s"))
    monthly = v.monthly_management.agg(F.sum(c("won_revenue").cast("decimal(38,2)")).alias("r"))
    return union_all(
        [
            _counts(
                leads,
                {
                    "sql_implies_mql": (c("is_sql") == 1) & (c("is_mql") == 0),
                    "lead_score_in_range": ~c("lead_score").between(0, 100),
                },
            ),
            _counts(s.fact_marketing_daily, {"spend_not_negative": c("spend") < 0}),
            _counts(
                deals,
                {
                    "won_value_not_negative": c("won_value") < 0,
                    "won_deal_has_value": (c("status") == "Won") & (c("won_value") <= 0),
                    "close_after_create": c("close_date_key") < c("created_date_key"),
                },
            ),
            _named("no_missing_critical_ids", union_all(missing_ids).agg(F.sum("n").alias("n"))),
            _named("opportunity_has_lead", anti_count(deals, leads, "lead_id", "lead_id")),
            _named(
                "customer_has_won_opportunity", anti_count(customers, won, "opportunity_id", "opportunity_id")
            ),
            _named(
                "customers_equal_won_opportunities",
                customers.agg(n_rows().alias("n")).select(F.abs(c("n") - won.agg(n_rows()).scalar()).alias("n")),
            ),
            _counts(
                by_channel,
                {
                    "funnel_is_monotonic": (c("mqls") > c("leads"))
                    | (c("sqls") > c("mqls"))
                    | (c("customers") > c("opportunities")),
                    "no_cac_for_unpaid_channels": (c("is_paid") == 0) & (c("spend") == 0) & c("cac").isNotNull(),
                },
            ),
            _named(
                "view_totals_match_facts",
                view_totals.select(
                    (
                        F.abs(c("l") - leads.agg(n_rows()).scalar())
                        + F.abs(rounded(c("s") - s.fact_marketing_daily.agg(F.sum("spend")).scalar(), 0))
                    ).alias("n")
                ),
            ),
            _named(
                "revenue_reconciles",
                monthly.select(F.abs(rounded(c("r") - won.agg(F.sum("won_value")).scalar(), 0)).alias("n")),
            ),
        ]
    )
