"""Two independent computations of the same figures, compared, and the KPI summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import count_where, dbl, mean, n_rows, ratio, rounded, total
from ..model import Star
from ..operators.rows import union_all
from .measures import MEASURES, Evaluator
from .model import ReportModel
from .views import Views

WHOLE = "Whole period"
RELATIVE, ABSOLUTE = 0.005, 0.01

WHOLE_PERIOD = [
    m for m in MEASURES if m not in ("mom_leads", "mom_revenue", "issues_after_cleaning")
    and m not in ("paid_spend", "paid_cac", "non_paid_revenue_share", "share_of_leads", "share_of_customers")
    and m not in ("arr_run_rate", "campaigns_to_scale", "campaigns_to_reduce")
]
BY_CHANNEL = ["leads", "customers", "won_revenue", "cpl", "cac", "win_rate"]
BY_MONTH = ["leads", "mom_leads", "mom_revenue"]


def _long(frame: DataFrame, scope: Column, values: dict[str, Column], out: str) -> DataFrame:
    """(scope, metric, out), one row per value of a wide frame."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), dbl(v).alias(out)) for m, v in values.items()])
    return frame.select(scope.alias("scope"), F.inline(cells))


def measured(model: ReportModel) -> DataFrame:
    """(scope, metric, measure_value) from the measure layer."""
    e = Evaluator(model)
    columns = lambda names: {m: F.col(m) for m in names}
    return union_all(
        [
            _long(e.evaluate(WHOLE_PERIOD), F.lit(WHOLE), columns(WHOLE_PERIOD), "measure_value"),
            _long(
                e.evaluate(BY_CHANNEL, ["DimChannel.channel_name"]),
                F.col("channel_name"),
                columns(BY_CHANNEL),
                "measure_value",
            ),
            _long(
                e.evaluate(BY_MONTH, ["DimDate.year_month"]), F.col("year_month"), columns(BY_MONTH), "measure_value"
            ),
        ]
    )


def _whole_period(star: Star, checks: DataFrame, row_counts: DataFrame) -> DataFrame:
    """The whole-period figures straight from the facts: one aggregate per fact, put side by side."""
    c = F.col
    won, active = c("is_won") == 1, c("is_active") == 1
    closed = c("status").isin("Won", "Lost")
    last_month = star.fact_customer_monthly.agg(F.max("year_month")).scalar()
    facts = {
        "mkt": star.fact_marketing_daily.agg(
            total("spend").alias("spend"),
            *[F.sum(x).alias(x) for x in ("impressions", "clicks", "sessions")],
        ),
        "lead": star.fact_leads.agg(
            n_rows().alias("leads"),
            F.sum("is_mql").alias("mqls"),
            F.sum("is_sql").alias("sqls"),
            mean("lead_score").alias("score"),
        ),
        "deal": star.fact_opportunities.agg(
            n_rows().alias("deals"),
            F.sum("is_won").alias("customers"),
            count_where(closed).alias("closed"),
            total(F.when(won, c("won_value"))).alias("revenue"),
            mean(F.when(won, c("won_value"))).alias("deal_value"),
            mean(F.when(won, c("sales_cycle_days"))).alias("cycle"),
            total(F.when(c("status") == "Open", c("expected_value"))).alias("open_value"),
            total(F.when(c("status") == "Lost", c("expected_value"))).alias("lost_value"),
        ),
        "bill": star.fact_customer_monthly.agg(
            total(F.when(active, c("mrr"))).alias("mrr"),
            total(F.when(active & (c("year_month") == last_month), c("mrr"))).alias("mrr_end"),
            F.count_distinct(F.when(active, c("customer_id"))).alias("active"),
            F.sum("is_churned").alias("churned"),
        ),
        "dq": checks.agg(
            F.sum("raw").alias("raw"),
            F.sum(F.when(c("severity") == "BLOCKING", c("clean"))).alias("blocking"),
            F.sum(F.when(c("severity") == "WARNING", c("clean"))).alias("warnings"),
        ),
        "rows": row_counts.agg(F.sum("clean_rows").alias("loaded"), F.sum("removed").alias("removed")),
    }
    one_row = star.spark.range(1).select(
        *[df.select(F.struct(*df.columns)).scalar().alias(name) for name, df in facts.items()]
    )
    spend, leads, customers = c("mkt.spend"), c("lead.leads"), c("deal.customers")
    values = {
        "total_spend": spend,
        "impressions": c("mkt.impressions"),
        "clicks": c("mkt.clicks"),
        "sessions": c("mkt.sessions"),
        "ctr": ratio("mkt.clicks", "mkt.impressions"),
        "cpc": ratio(spend, "mkt.clicks"),
        "leads": leads,
        "mqls": c("lead.mqls"),
        "sqls": c("lead.sqls"),
        "avg_lead_score": c("lead.score"),
        "opportunities": c("deal.deals"),
        "customers": customers,
        "session_to_lead_rate": ratio(leads, "mkt.sessions"),
        "lead_to_mql_rate": ratio("lead.mqls", leads),
        "mql_to_sql_rate": ratio("lead.sqls", "lead.mqls"),
        "sql_to_customer_rate": ratio(customers, "lead.sqls"),
        "lead_to_customer_rate": ratio(customers, leads),
        "cpl": ratio(spend, leads),
        "cac": ratio(spend, customers),
        "revenue_per_spend": ratio("deal.revenue", spend),
        "won_revenue": c("deal.revenue"),
        "average_deal_value": c("deal.deal_value"),
        "average_sales_cycle": c("deal.cycle"),
        "win_rate": ratio(customers, "deal.closed"),
        "open_pipeline": c("deal.open_value"),
        "lost_value": c("deal.lost_value"),
        "mrr": c("bill.mrr"),
        "mrr_end_of_period": c("bill.mrr_end"),
        "active_customers": c("bill.active"),
        "churned_customers": c("bill.churned"),
        "churn_rate": ratio("bill.churned", c("bill.active") + c("bill.churned")),
        "issues_found_raw": c("dq.raw"),
        "blocking_errors_left": c("dq.blocking"),
        "documented_warnings": c("dq.warnings"),
        "rows_loaded": c("rows.loaded"),
        "rows_removed": c("rows.removed"),
    }
    return _long(one_row, F.lit(WHOLE), values, "view_value")


def viewed(views: Views, checks: DataFrame, row_counts: DataFrame) -> DataFrame:
    """(scope, metric, view_value) from the facts and the reporting views."""
    closed = (
        views.star.fact_opportunities.where(F.col("status").isin("Won", "Lost"))
        .groupBy("channel_id")
        .agg(n_rows().alias("closed"))
    )
    channels = views.channel_performance.join(closed, "channel_id", "left").withColumn(
        "win_rate", ratio("customers", "closed")
    )
    return union_all(
        [
            _whole_period(views.star, checks, row_counts),
            _long(channels, F.col("channel_name"), {m: F.col(m) for m in BY_CHANNEL}, "view_value"),
            _long(
                views.monthly_management, F.col("year_month"), {m: F.col(m) for m in BY_MONTH}, "view_value"
            ),
        ]
    )


def reconciliation(model: ReportModel, views: Views) -> DataFrame:
    """(scope, metric, measure_value, view_value, status).

    A channel or month is compared where both sides have it; the whole-period list must match in full. Two blanks
    agree, one blank does not.
    """
    left = measured(model).withColumn("_measured", F.lit(True))
    right = viewed(views, model["DataQualityChecks"], model["DataQualityRowCounts"]).withColumn("_viewed", F.lit(True))
    a, b = F.col("measure_value"), F.col("view_value")
    tolerance = F.greatest(F.lit(ABSOLUTE), F.lit(RELATIVE) * F.abs(b))
    agrees = F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a - b) <= tolerance)
    return (
        left.join(right, ["scope", "metric"], "full_outer")
        .where((F.col("scope") == WHOLE) | (F.col("_measured") & F.col("_viewed")))
        .select("scope", "metric", "measure_value", "view_value", F.when(agrees, "PASS").otherwise("FAIL").alias("status"))
    )


def reconciliation_summary(result: DataFrame) -> DataFrame:
    return result.agg(
        n_rows().alias("comparisons"),
        count_where(F.col("status") == "PASS").alias("passed"),
        count_where(F.col("status") == "FAIL").alias("failed"),
    )


def kpi_summary(views: Views) -> DataFrame:
    """One row with the figures a summary quotes."""
    c = F.col
    exact = lambda name: c(name).cast("decimal(38,2)")
    paid = c("is_paid") == 1
    activity = views.star.fact_marketing_daily.agg(
        F.struct(
            total("spend").alias("spend"),
            *[F.sum(x).alias(x) for x in ("impressions", "clicks", "sessions")],
        )
    ).scalar()
    outcome = views.lead_outcomes.agg(
        F.struct(
            n_rows().alias("leads"),
            F.sum("is_mql").alias("mqls"),
            F.sum("is_sql").alias("sqls"),
            F.sum("has_opportunity").alias("opportunities"),
            F.sum("is_customer").alias("customers"),
            total("won_value").alias("revenue"),
        )
    ).scalar()
    last = views.monthly_management.agg(
        F.max_by(F.struct("mrr", "active_customers"), "year_month")
    ).scalar()
    by_revenue = F.struct("won_revenue", "channel_name")
    by_cac = F.when(paid & c("cac").isNotNull(), F.struct("cac", "channel_name"))
    channels = views.channel_performance.agg(
        ratio(F.sum(F.when(paid, exact("spend"))), F.sum(F.when(paid, c("customers")))).alias("paid_cac"),
        ratio(F.sum(F.when(~paid, exact("won_revenue"))), F.sum(exact("won_revenue"))).alias("non_paid_share"),
        F.max_by("channel_name", by_revenue).alias("top_revenue_channel"),
        F.min_by("channel_name", by_cac).alias("lowest_paid_cac_channel"),
    )
    first, final = [f"{p // 10000:04d}-{p // 100 % 100:02d}-{p % 100:02d}" for p in views.star.period]
    wide = channels.withColumns({"m": activity, "f": outcome, "l": last})
    return wide.select(
        F.lit(f"{first} to {final}").alias("period"),
        rounded("m.spend", 2).alias("total_spend"),
        "m.impressions",
        "m.clicks",
        "m.sessions",
        "f.leads",
        "f.mqls",
        "f.sqls",
        "f.opportunities",
        "f.customers",
        rounded("f.revenue", 2).alias("won_revenue"),
        rounded(F.lit(100.0) * ratio("m.clicks", "m.impressions"), 2).alias("ctr_pct"),
        rounded(ratio("m.spend", "f.leads"), 2).alias("blended_cpl"),
        rounded(ratio("m.spend", "f.customers"), 2).alias("blended_cac"),
        rounded(F.lit(100.0) * ratio("f.customers", "f.leads"), 2).alias("lead_to_customer_pct"),
        rounded(ratio("f.revenue", "m.spend"), 2).alias("revenue_to_spend"),
        rounded("paid_cac", 2).alias("paid_cac"),
        rounded(F.lit(100.0) * c("non_paid_share"), 1).alias("non_paid_revenue_share_pct"),
        rounded("l.mrr", 2).alias("ending_mrr"),
        F.col("l.active_customers").alias("active_customers_end"),
        "top_revenue_channel",
        "lowest_paid_cac_channel",
    )
