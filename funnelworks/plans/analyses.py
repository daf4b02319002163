"""The 38 analysis questions, each a short plan over the views or the star.

``ANALYSES`` maps the question id to (group, title, plan). Results are ordered as a report shows them; ties are broken
by name so that a run is repeatable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import STAGES, paid_label, score_band
from ..functions.numeric import count_where, dbl, mean, n_rows, pct, ratio, rounded, total
from ..model import STAR_TABLES
from ..operators.rows import anti_count, rows_of, union_all
from .views import Views

ANALYSES: dict[str, tuple[str, str, Callable[[Views], DataFrame]]] = {}


def analysis(ident: str, group: str, title: str):
    def register(plan):
        ANALYSES[ident] = (group, title, plan)
        return plan

    return register


def one(df: DataFrame, value) -> Column:
    """A one-row aggregate of another frame as a scalar subquery."""
    return df.select(value).scalar()


def share_of_all(c: str) -> Column:
    """Percentage of the column total; the window runs on an already aggregated frame."""
    return pct(c, F.sum(c).over(Window.partitionBy()))


# ------------------------------------------------------------------ data quality
@analysis("q25a", "data quality", "Row counts per table")
def row_counts(v: Views) -> DataFrame:
    return union_all(
        [v.star[t].agg(n_rows().alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t in STAR_TABLES]
    )


@analysis("q25b", "data quality", "Business-rule failures")
def business_rules(v: Views) -> DataFrame:
    c = F.col
    rules = {
        "fact_leads": {
            "SQL implies MQL": (c("is_sql") == 1) & (c("is_mql") == 0),
            "Lead score 0-100": ~c("lead_score").between(0, 100),
        },
        "fact_marketing_daily": {
            "Spend >= 0": c("spend") < 0,
            "Clicks <= impressions": c("clicks") > c("impressions"),
        },
        "fact_opportunities": {
            "Won value >= 0": c("won_value") < 0,
            "Won deal has a value": (c("status") == "Won") & (c("won_value") <= 0),
            "Close date after creation": c("close_date_key") < c("created_date_key"),
            "Status is Won/Lost/Open": ~c("status").isin(STAGES),
        },
    }
    frames = []
    for table, checks in rules.items():
        counted = v.star[table].agg(*[count_where(cond).alias(f"n{i}") for i, cond in enumerate(checks.values())])
        frames.append(
            rows_of(counted, rule=[F.lit(r) for r in checks], failures=[F.col(f"n{i}") for i in range(len(checks))])
        )
    return union_all(frames)


@analysis("q25c", "data quality", "Orphans per relation")
def orphans(v: Views) -> DataFrame:
    s = v.star
    won = s.fact_opportunities.where("is_won = 1")
    relations = [
        ("lead -> channel", s.fact_leads, s.dim_channel, "channel_id", "channel_id"),
        ("lead -> region", s.fact_leads, s.dim_region, "region_id", "region_id"),
        ("opportunity -> lead", s.fact_opportunities, s.fact_leads, "lead_id", "lead_id"),
        ("customer -> won opportunity", s.dim_customer, won, "opportunity_id", "opportunity_id"),
        ("marketing -> date", s.fact_marketing_daily, s.dim_date, "date_key", "date_key"),
    ]
    return union_all(
        [
            anti_count(left, right, lk, rk).select(F.lit(name).alias("relation"), F.col("n").alias("orphans"))
            for name, left, right, lk, rk in relations
        ]
    )


@analysis("q25d", "data quality", "Repeated business keys")
def repeated_keys(v: Views) -> DataFrame:
    grains = [
        ("fact_marketing_daily (date, campaign)", v.star.fact_marketing_daily, ["date_key", "campaign_id"]),
        ("fact_customer_monthly (customer, month)", v.star.fact_customer_monthly, ["customer_id", "year_month"]),
        ("dim_customer (opportunity)", v.star.dim_customer, ["opportunity_id"]),
    ]
    return union_all(
        [
            df.groupBy(*keys)
            .agg(n_rows().alias("c"))
            .agg(count_where(F.col("c") > 1).alias("duplicated_keys"))
            .select(F.lit(name).alias("grain"), "duplicated_keys")
            for name, df, keys in grains
        ]
    )


@analysis("q25e", "data quality", "Documented warnings")
def warnings(v: Views) -> DataFrame:
    leads = v.star.fact_leads.agg(
        n_rows().alias("all"),
        count_where(F.col("lead_score").isNull()).alias("unscored"),
        count_where(F.col("campaign_id").isNull()).alias("unassigned"),
    )
    deals = v.star.fact_opportunities.agg(
        count_where(F.col("is_won") == 1).alias("won"), count_where(F.col("value_imputed") == 1).alias("imputed")
    )
    return rows_of(
        leads,
        warning=[F.lit("Lead score unknown (NULL)"), F.lit("Lead with unassigned campaign")],
        rows_affected=[F.col("unscored"), F.col("unassigned")],
        pct_of_leads=[pct("unscored", "all", 2), pct("unassigned", "all", 2)],
    ).unionByName(
        deals.select(
            F.lit("Won value imputed from expected value").alias("warning"),
            F.col("imputed").alias("rows_affected"),
            pct("imputed", "won", 2).alias("pct_of_leads"),
        )
    )


@analysis("q25f", "data quality", "Days with marketing data per month")
def marketing_coverage(v: Views) -> DataFrame:
    within = v.star.in_months("fact_marketing_daily", *v.star.period)
    active = within.select("date_key").distinct().withColumn("active_key", F.col("date_key"))
    return (
        v.star.dim_date.where(F.col("date_key").between(*v.star.period))
        .join(active, "date_key", "left")
        .groupBy("year_month")
        .agg(
            F.count_distinct("date_key").alias("calendar_days"),
            F.count_distinct("active_key").alias("days_with_marketing_data"),
        )
        .withColumn("missing_days", F.col("calendar_days") - F.col("days_with_marketing_data"))
        .orderBy("year_month")
    )


# ------------------------------------------------------------------ KPIs
@analysis("q00", "kpi", "Executive summary")
def executive_summary(v: Views) -> DataFrame:
    activity = v.star.fact_marketing_daily.agg(
        F.struct(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("sessions").alias("sessions"),
            total("spend").alias("spend"),
        ).alias("m")
    )
    outcome = v.lead_outcomes.agg(
        n_rows().alias("leads"),
        F.sum("is_mql").alias("mqls"),
        F.sum("is_sql").alias("sqls"),
        F.sum("has_opportunity").alias("opportunities"),
        F.sum("is_customer").alias("customers"),
        total("won_value").alias("revenue"),
    )
    return outcome.withColumn("m", activity.scalar()).select(
        rounded("m.spend", 0).alias("total_spend"),
        "m.sessions",
        "leads",
        "mqls",
        "sqls",
        "opportunities",
        "customers",
        rounded("revenue", 0).alias("won_revenue"),
        pct("m.clicks", "m.impressions", 2).alias("ctr_pct"),
        rounded(ratio("m.spend", "leads"), 2).alias("blended_cpl"),
        rounded(ratio("m.spend", "customers"), 2).alias("blended_cac"),
        pct("customers", "leads", 2).alias("lead_to_customer_pct"),
        rounded(ratio("revenue", "m.spend"), 2).alias("revenue_to_spend"),
    )


@analysis("q03", "kpi", "Cost per lead by channel")
def cost_per_lead(v: Views) -> DataFrame:
    spending = v.channel_performance.where("spend > 0")
    return spending.select("channel_name", "spend", "leads", "cpl").orderBy("cpl", "channel_name")


@analysis("q04", "kpi", "Acquisition cost against deal value")
def payback(v: Views) -> DataFrame:
    return v.channel_performance.select(
        "channel_name",
        "customers",
        "cac",
        "avg_deal_value",
        rounded(ratio("avg_deal_value", "cac"), 2).alias("deal_value_to_cac"),
        F.when(F.col("cac").isNull(), "No paid spend")
        .when(F.col("cac") > F.col("avg_deal_value"), "Pays back after year 1")
        .otherwise("Pays back within year 1")
        .alias("payback"),
    ).orderBy(F.col("cac").asc_nulls_last(), "channel_name")


@analysis("q20", "kpi", "Paid against non-paid acquisition")
def paid_vs_non_paid(v: Views) -> DataFrame:
    money = [F.sum(F.col(c).cast("decimal(38,2)")).alias(c) for c in ("spend", "won_revenue")]
    grouped = (
        v.channel_performance.groupBy(paid_label("is_paid").alias("source_type"))
        .agg(*money, F.sum("leads").alias("leads"), F.sum("customers").alias("customers"))
        .withColumn("revenue_share_pct", share_of_all("won_revenue"))
    )
    return grouped.select(
        "source_type",
        rounded("spend", 0).alias("spend"),
        "leads",
        "customers",
        rounded("won_revenue", 0).alias("won_revenue"),
        "revenue_share_pct",
        pct("customers", "leads", 2).alias("lead_to_customer_pct"),
        rounded(ratio("spend", "customers"), 0).alias("cac"),
    )


@analysis("q14", "kpi", "Lead score by channel")
def score_by_channel(v: Views) -> DataFrame:
    s = F.col("lead_score")
    totals = v.star.fact_leads.groupBy("channel_id").agg(
        n_rows().alias("leads"),
        F.count(s).alias("scored_leads"),
        mean(s).alias("score_mean"),
        count_where(s >= 70).alias("high"),
        count_where(s < 40).alias("low"),
    )
    return (
        totals.join(v.star.dim_channel, "channel_id")
        .select(
            "channel_name",
            "leads",
            "scored_leads",
            rounded("score_mean", 1).alias("avg_score"),
            pct("high", "scored_leads").alias("pct_high_score"),
            pct("low", "scored_leads").alias("pct_low_score"),
        )
        .orderBy(F.col("avg_score").desc_nulls_last(), "channel_name")
    )


@analysis("q15", "kpi", "Month-over-month lead growth")
def lead_growth(v: Views) -> DataFrame:
    before = F.lag("leads").over(Window.orderBy("year_month"))
    return (
        v.lead_outcomes.groupBy("year_month")
        .agg(n_rows().alias("leads"))
        .withColumn("previous_month", before)
        .withColumn("mom_growth_pct", pct(F.col("leads") - F.col("previous_month"), "previous_month"))
        .orderBy("year_month")
    )


@analysis("q16", "kpi", "Revenue growth and three-month mean")
def revenue_growth(v: Views) -> DataFrame:
    last_three = Window.orderBy("year_month").rowsBetween(-2, Window.currentRow)
    exact = F.col("won_revenue").cast("decimal(38,2)")
    return v.monthly_management.select(
        "year_month",
        "won_revenue",
        rounded(F.lit(100.0) * F.col("mom_revenue"), 1).alias("mom_growth_pct"),
        rounded(ratio(F.sum(exact).over(last_three), F.count(exact).over(last_three)), 0).alias("rolling_3m_revenue"),
    ).orderBy("year_month")


@analysis("q23", "kpi", "Recurring revenue, net new and annual run rate")
def recurring_revenue(v: Views) -> DataFrame:
    before = F.lag("mrr").over(Window.orderBy("year_month"))
    return v.monthly_management.select(
        "year_month",
        "active_customers",
        "mrr",
        rounded(F.col("mrr") - before, 2).alias("net_new_mrr"),
        rounded(F.col("mrr") * 12, 0).alias("arr_run_rate"),
    ).orderBy("year_month")


@analysis("q24", "kpi", "Monthly logo churn")
def churn_by_month(v: Views) -> DataFrame:
    return v.monthly_management.select(
        "year_month",
        "active_customers",
        "churned_customers",
        rounded(F.lit(100.0) * F.col("churn_rate"), 2).alias("churn_rate_pct"),
    ).orderBy("year_month")


@analysis("q24b", "kpi", "Churn by acquisition channel")
def churn_by_channel(v: Views) -> DataFrame:
    return (
        _customers(v)
        .groupBy("channel_name")
        .agg(
            n_rows().alias("customers"),
            F.sum("has_churned").alias("churned"),
            pct(F.sum("has_churned"), n_rows()).alias("churned_pct"),
            rounded(mean("starting_mrr"), 2).alias("avg_starting_mrr"),
        )
        .orderBy(F.col("churned_pct").desc_nulls_last(), "channel_name")
    )


def _customers(v: Views) -> DataFrame:
    """Customer view with exact starting amounts, so that sums do not depend on row order."""
    return v.customer_value.withColumn("starting_mrr", F.col("starting_mrr").cast("decimal(18,2)"))


# ------------------------------------------------------------------ campaigns
@analysis("q02", "campaign", "Funnel by campaign")
def funnel_by_campaign(v: Views) -> DataFrame:
    totals = v.funnel_totals("campaign_id", "channel_id")
    counted = ["leads", "mqls", "sqls", "opportunities", "customers"]
    return (
        totals.join(v.star.dim_channel.select("channel_id", "channel_name"), "channel_id")
        .join(v.star.dim_campaign.select("campaign_id", "campaign_name"), "campaign_id", "left")
        .groupBy(F.coalesce("campaign_name", F.lit("Unassigned")).alias("campaign_name"), "channel_name")
        .agg(*[F.sum(c).alias(c) for c in counted])
        .withColumns(
            {"lead_to_sql_pct": pct("sqls", "leads"), "lead_to_customer_pct": pct("customers", "leads", 2)}
        )
        .orderBy(F.col("leads").desc(), "campaign_name", "channel_name")
    )


@analysis("q10", "campaign", "Revenue rank overall and in channel")
def revenue_ranks(v: Views) -> DataFrame:
    by_revenue = F.col("won_revenue").desc()
    return v.campaign_performance.select(
        "campaign_name",
        "channel_name",
        "won_revenue",
        F.dense_rank().over(Window.orderBy(by_revenue)).alias("rank_overall"),
        F.dense_rank().over(Window.partitionBy("channel_name").orderBy(by_revenue)).alias("rank_in_channel"),
    ).orderBy(by_revenue, "campaign_name")


@analysis("q17", "campaign", "Best paid campaigns")
def best_campaigns(v: Views) -> DataFrame:
    columns = [
        "campaign_name", "channel_name", "spend", "customers",
        "won_revenue", "cac", "revenue_to_spend", "recommendation",
    ]
    return (
        v.campaign_performance.where("spend > 0 AND customers >= 5")
        .select(*columns)
        .orderBy(F.col("revenue_to_spend").desc(), "campaign_name")
    )


@analysis("q18", "campaign", "High spend, weak conversion")
def budget_waste(v: Views) -> DataFrame:
    spends = F.when(F.col("spend") > 0, F.col("spend").cast("decimal(38,2)"))
    typical = mean(spends).alias("typical")
    overall = ratio(F.sum("is_sql"), n_rows())
    campaigns = v.campaign_performance
    return (
        campaigns.where(F.col("spend") > one(campaigns, typical))
        .where(F.col("lead_to_sql_rate") < one(v.star.fact_leads, overall))
        .select(
            "campaign_name",
            "channel_name",
            "spend",
            "leads",
            "sqls",
            rounded(F.lit(100.0) * F.col("lead_to_sql_rate"), 1).alias("lead_to_sql_pct"),
            "customers",
            "cac",
            "recommendation",
        )
        .orderBy(F.col("spend").desc(), "campaign_name")
    )


@analysis("q18b", "campaign", "Budget by recommendation")
def budget_by_recommendation(v: Views) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(x) for x in ("SCALE", "MAINTAIN", "OPTIMISE", "REDUCE")]), F.col("recommendation"))
    return (
        v.campaign_performance.where("recommendation <> 'NON-PAID'")
        .groupBy("recommendation")
        .agg(
            n_rows().alias("campaigns"),
            rounded(F.sum(F.col("spend").cast("decimal(38,2)")), 0).alias("spend"),
            rounded(F.sum(F.col("won_revenue").cast("decimal(38,2)")), 0).alias("won_revenue"),
            F.array_join(F.sort_array(F.collect_list("campaign_name")), ", ").alias("campaign_list"),
        )
        .orderBy(order)
    )


@analysis("q17b", "campaign", "Monthly trend of the top three campaigns")
def top_campaign_trend(v: Views) -> DataFrame:
    top = (
        v.campaign_performance.where("spend > 0")
        .orderBy(F.col("revenue_to_spend").desc(), "campaign_id")
        .limit(3)
        .select("campaign_id", "campaign_name")
    )
    leads = v.lead_outcomes.groupBy("campaign_id", "year_month").agg(n_rows().alias("leads"))
    return (
        v.star.fact_marketing_daily.join(top, "campaign_id")
        .join(v.star.dim_date.select("date_key", "year_month"), "date_key")
        .groupBy("campaign_id", "campaign_name", "year_month")
        .agg(rounded(F.sum("spend"), 0).alias("spend"), F.sum("sessions").alias("sessions"))
        .join(leads, ["campaign_id", "year_month"], "left")
        .select("campaign_name", "year_month", "spend", "sessions", F.coalesce("leads", F.lit(0)).alias("leads"))
        .orderBy("campaign_name", "year_month")
    )


# ------------------------------------------------------------------ funnel
@analysis("q01", "funnel", "Full funnel by channel")
def full_funnel(v: Views) -> DataFrame:
    return v.channel_performance.select(
        "channel_name",
        "sessions",
        "leads",
        "mqls",
        "sqls",
        "opportunities",
        "customers",
        pct("leads", "sessions", 2).alias("session_to_lead_pct"),
        pct("mqls", "leads").alias("lead_to_mql_pct"),
        pct("sqls", "mqls").alias("mql_to_sql_pct"),
        pct("customers", "sqls").alias("sql_to_customer_pct"),
        pct("customers", "leads", 2).alias("lead_to_customer_pct"),
    ).orderBy(F.col("customers").desc_nulls_last(), "channel_name")


@analysis("q05_08", "funnel", "Company-wide stage conversion")
def stage_conversion(v: Views) -> DataFrame:
    volume, previous = F.sum("volume"), F.sum("previous_volume")
    return (
        v.funnel.groupBy("stage_order", "stage")
        .agg(
            volume.alias("volume"),
            pct(volume, previous).alias("conversion_from_previous_pct"),
            pct(previous - volume, previous).alias("drop_off_pct"),
        )
        .orderBy("stage_order")
        .drop("stage_order")
    )


@analysis("q01b", "funnel", "Weakest step per channel")
def weakest_step(v: Views) -> DataFrame:
    worst_first = Window.partitionBy("channel_name").orderBy(F.col("drop_off").desc_nulls_last())
    return (
        v.funnel.where("stage_order >= 3")
        .withColumn("place", F.rank().over(worst_first))
        .where("place = 1")
        .select(
            "channel_name",
            F.col("stage").alias("weakest_transition_into"),
            rounded(F.lit(100.0) * F.col("drop_off"), 1).alias("drop_off_pct"),
        )
        .orderBy(F.col("drop_off_pct").desc_nulls_last(), "channel_name")
    )


@analysis("q19", "funnel", "High quality, low volume channels")
def hidden_gems(v: Views) -> DataFrame:
    channels = v.channel_performance
    overall = ratio(F.sum("is_sql"), n_rows())
    return (
        channels.where(F.col("lead_to_sql_rate") > one(v.star.fact_leads, overall))
        .where(F.col("leads") < one(channels, mean("leads")))
        .select(
            "channel_name",
            "leads",
            rounded(F.lit(100.0) * F.col("lead_to_sql_rate"), 1).alias("lead_to_sql_pct"),
            rounded(F.lit(100.0) * F.col("lead_to_customer_rate"), 1).alias("lead_to_customer_pct"),
            "avg_lead_score",
        )
        .orderBy(F.col("lead_to_sql_pct").desc(), "channel_name")
    )


@analysis("q19b", "funnel", "Share of leads against share of customers")
def volume_vs_quality(v: Views) -> DataFrame:
    return v.channel_performance.select(
        "channel_name",
        "leads",
        share_of_all("leads").alias("share_of_leads_pct"),
        share_of_all("customers").alias("share_of_customers_pct"),
        rounded(F.lit(100.0) * F.col("lead_to_sql_rate"), 1).alias("lead_to_sql_pct"),
    ).orderBy(
        (F.col("share_of_leads_pct") - F.col("share_of_customers_pct")).desc_nulls_last(), "channel_name"
    )


@analysis("q14b", "funnel", "Conversion by lead-score band")
def conversion_by_score(v: Views) -> DataFrame:
    return (
        v.lead_outcomes.groupBy(score_band("lead_score").alias("score_band"))
        .agg(
            n_rows().alias("leads"),
            pct(F.sum("is_mql"), n_rows()).alias("mql_pct"),
            pct(F.sum("is_sql"), n_rows()).alias("sql_pct"),
            pct(F.sum("is_customer"), n_rows(), 2).alias("customer_pct"),
            F.min(F.coalesce("lead_score", F.lit(-1))).alias("lowest"),
        )
        .orderBy("lowest")
        .drop("lowest")
    )


@analysis("q01c", "funnel", "Monthly conversion trend")
def conversion_trend(v: Views) -> DataFrame:
    return (
        v.lead_outcomes.groupBy("year_month")
        .agg(
            n_rows().alias("leads"),
            pct(F.sum("is_mql"), n_rows()).alias("lead_to_mql_pct"),
            pct(F.sum("is_sql"), F.sum("is_mql")).alias("mql_to_sql_pct"),
            rounded(mean("lead_score"), 1).alias("avg_score"),
        )
        .orderBy("year_month")
    )


# ------------------------------------------------------------------ revenue
@analysis("q09_11", "revenue", "Revenue share and Pareto curve")
def revenue_pareto(v: Views) -> DataFrame:
    biggest_first = Window.orderBy(F.col("won_revenue").desc_nulls_last(), "channel_name")
    running = F.sum(F.col("revenue_share").cast("decimal(9,4)")).over(
        biggest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return v.channel_performance.select(
        "channel_name",
        "won_revenue",
        rounded(F.lit(100.0) * F.col("revenue_share"), 1).alias("revenue_share_pct"),
        rounded(F.lit(100.0) * dbl(running), 1).alias("cumulative_share_pct"),
    ).orderBy(F.col("won_revenue").desc_nulls_last(), "channel_name")


def _deals(v: Views) -> DataFrame:
    """Opportunity view with exact amounts."""
    exact = {c: F.col(c).cast("decimal(18,2)") for c in ("expected_value", "won_value", "open_pipeline_value")}
    return v.opportunity_detail.withColumns(exact)


@analysis("q12", "revenue", "Win rate and deal value by channel")
def win_rate(v: Views) -> DataFrame:
    won = F.col("status") == "Won"
    return (
        _deals(v)
        .where(F.col("status").isin("Won", "Lost"))
        .groupBy("channel_name")
        .agg(
            n_rows().alias("closed_opportunities"),
            count_where(won).alias("won"),
            pct(count_where(won), n_rows()).alias("win_rate_pct"),
            rounded(mean(F.when(won, F.col("won_value"))), 0).alias("avg_deal_value"),
        )
        .orderBy(F.col("avg_deal_value").desc_nulls_last(), "channel_name")
    )


@analysis("q13", "revenue", "Sales cycle by company size")
def sales_cycle(v: Views) -> DataFrame:
    cycle = lambda status: rounded(mean(F.when(F.col("status") == status, F.col("sales_cycle_days"))), 1)
    return (
        v.opportunity_detail.where(F.col("status").isin("Won", "Lost"))
        .groupBy("company_size")
        .agg(
            cycle("Won").alias("won_cycle_days"),
            cycle("Lost").alias("lost_cycle_days"),
            F.count("sales_cycle_days").alias("deals_with_known_cycle"),
        )
        .orderBy(F.col("won_cycle_days").asc_nulls_first(), "company_size")
    )


@analysis("q21", "revenue", "Performance by region")
def by_region(v: Views) -> DataFrame:
    return (
        v.funnel_totals("region_id")
        .join(v.star.dim_region, "region_id")
        .select(
            "region_group",
            "region_name",
            "leads",
            "customers",
            pct("customers", "leads", 2).alias("lead_to_customer_pct"),
            rounded("won_revenue", 0).alias("won_revenue"),
            rounded(ratio("won_revenue", "customers"), 0).alias("avg_deal_value"),
        )
        .orderBy(F.col("won_revenue").desc(), "region_name")
    )


@analysis("q22", "revenue", "Performance by company size")
def by_company_size(v: Views) -> DataFrame:
    all_revenue = F.sum(F.col("won_revenue").cast("decimal(38,2)")).over(Window.partitionBy())
    return (
        v.funnel_totals("company_size")
        .select(
            "company_size",
            "leads",
            "customers",
            pct("customers", "leads", 2).alias("lead_to_customer_pct"),
            rounded(ratio("won_revenue", "customers"), 0).alias("avg_deal_value"),
            pct("won_revenue", all_revenue).alias("revenue_share_pct"),
        )
        .orderBy(F.col("avg_deal_value").desc_nulls_last(), "company_size")
    )


@analysis("q13b", "revenue", "Opportunity value by status")
def value_by_status(v: Views) -> DataFrame:
    return (
        _deals(v)
        .groupBy("status")
        .agg(
            n_rows().alias("opportunities"),
            rounded(F.sum("expected_value"), 0).alias("expected_value"),
            rounded(F.sum("won_value"), 0).alias("won_value"),
            rounded(mean("expected_value"), 0).alias("avg_expected_value"),
        )
        .orderBy(F.col("opportunities").desc(), "status")
    )


@analysis("q13c", "revenue", "Open value by campaign")
def open_value(v: Views) -> DataFrame:
    return (
        _deals(v)
        .where("status = 'Open'")
        .groupBy("campaign_name", "channel_name")
        .agg(n_rows().alias("open_opportunities"), F.sum("open_pipeline_value").alias("open_value"))
        .where("open_value > 0")
        .select(
            "campaign_name",
            "channel_name",
            "open_opportunities",
            rounded("open_value", 0).alias("open_pipeline_value"),
        )
        .orderBy(F.col("open_pipeline_value").desc(), "campaign_name", "channel_name")
    )


@analysis("q12b", "revenue", "Plan mix")
def plan_mix(v: Views) -> DataFrame:
    return (
        _customers(v)
        .groupBy("plan")
        .agg(
            n_rows().alias("customers"),
            rounded(mean("starting_mrr"), 2).alias("avg_starting_mrr"),
            rounded(F.sum("starting_mrr"), 2).alias("starting_mrr_total"),
            pct(F.sum("has_churned"), n_rows()).alias("churned_pct"),
        )
        .orderBy(F.col("avg_starting_mrr").desc(), "plan")
    )


@analysis("q23b", "revenue", "New customers and revenue by month and source")
def new_customers(v: Views) -> DataFrame:
    return (
        _customers(v)
        .groupBy("acquisition_month", "channel_name")
        .agg(n_rows().alias("n"), F.sum("starting_mrr").alias("mrr"))
        .join(v.star.dim_channel.select("channel_name", "is_paid"), "channel_name")
        .groupBy("acquisition_month", paid_label("is_paid").alias("source_type"))
        .agg(F.sum("n").alias("new_customers"), rounded(F.sum("mrr"), 2).alias("new_mrr"))
        .orderBy("acquisition_month", "source_type")
    )
