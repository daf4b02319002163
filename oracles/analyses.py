"""Expected results of the 38 analysis questions."""

from __future__ import annotations

from .compose import big, div, mean, pct, rnd, union

FACTS_AND_DIMS = [
    "dim_date", "dim_channel", "dim_campaign", "dim_region", "dim_customer",
    "fact_marketing_daily", "fact_leads", "fact_opportunities", "fact_customer_monthly",
]


def _rule(label: str, table: str, broken: str) -> str:
    return f"SELECT '{label}' AS rule, count(*) AS failures FROM {table} WHERE {broken}"


def _orphan(label: str, child: str, parent: str, key: str) -> str:
    return f"SELECT '{label}' AS relation, count(*) AS orphans FROM {child} ANTI JOIN {parent} USING ({key})"


def _repeated(label: str, table: str, keys: str) -> str:
    return f"""SELECT '{label}' AS grain, count(*) FILTER (WHERE n > 1) AS duplicated_keys
               FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""


def _warning(label: str, table: str, hit: str, base: str = "TRUE") -> str:
    n, of = f"count(*) FILTER (WHERE {hit})", f"count(*) FILTER (WHERE {base})"
    return f"SELECT '{label}' AS warning, {n} AS rows_affected, {pct(n, of, 2)} AS pct_of_leads FROM {table}"


def cents(column: str) -> str:
    return f"{column}::DECIMAL(38,2)"


ALL = "(SELECT sum({c}) FROM {t})"
CLOSED = "status IN ('Won', 'Lost')"

ANALYSIS_QUERIES = {
    "q25a_row_counts": union(
        [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in FACTS_AND_DIMS]
    ),
    "q25b_business_rules": union(
        [
            _rule("SQL implies MQL", "fact_leads", "is_sql > is_mql"),
            _rule("Spend >= 0", "fact_marketing_daily", "spend < 0"),
            _rule("Clicks <= impressions", "fact_marketing_daily", "impressions < clicks"),
            _rule("Lead score 0-100", "fact_leads", "lead_score < 0 OR lead_score > 100"),
            _rule("Won value >= 0", "fact_opportunities", "won_value < 0"),
            _rule("Won deal has a value", "fact_opportunities", "won_value <= 0 AND status = 'Won'"),
            _rule("Close date after creation", "fact_opportunities", "created_date_key > close_date_key"),
            _rule("Status is Won/Lost/Open", "fact_opportunities", "list_position(['Won', 'Lost', 'Open'], status) IS NULL"),
        ]
    ),
    "q25c_orphans": union(
        [
            _orphan("lead -> channel", "fact_leads", "dim_channel", "channel_id"),
            _orphan("lead -> region", "fact_leads", "dim_region", "region_id"),
            _orphan("opportunity -> lead", "fact_opportunities", "fact_leads", "lead_id"),
            _orphan(
                "customer -> won opportunity",
                "dim_customer",
                "(SELECT opportunity_id FROM fact_opportunities WHERE is_won = 1)",
                "opportunity_id",
            ),
            _orphan("marketing -> date", "fact_marketing_daily", "dim_date", "date_key"),
        ]
    ),
    "q25d_repeated_keys": union(
        [
            _repeated("fact_marketing_daily (date, campaign)", "fact_marketing_daily", "date_key, campaign_id"),
            _repeated("fact_customer_monthly (customer, month)", "fact_customer_monthly", "customer_id, year_month"),
            _repeated("dim_customer (opportunity)", "dim_customer", "opportunity_id"),
        ]
    ),
    "q25e_warnings": union(
        [
            _warning("Lead score unknown (NULL)", "fact_leads", "lead_score IS NULL"),
            _warning("Lead with unassigned campaign", "fact_leads", "campaign_id IS NULL"),
            _warning(
                "Won value imputed from expected value", "fact_opportunities", "value_imputed = 1", "is_won = 1"
            ),
        ]
    ),
    "q25f_marketing_coverage": """
        SELECT year_month, count(*) AS calendar_days, count(m.date_key) AS days_with_marketing_data,
               count(*) - count(m.date_key) AS missing_days
        FROM dim_date d LEFT JOIN (SELECT DISTINCT date_key FROM fact_marketing_daily) m USING (date_key)
        WHERE d.date_key BETWEEN (SELECT strftime(first_day, '%Y%m%d')::INTEGER FROM months) AND (SELECT strftime(last_day, '%Y%m%d')::INTEGER FROM months) GROUP BY year_month""",
    "q00_executive_summary": f"""
        SELECT {rnd("spend", 0)} AS total_spend, sessions, leads, mqls, sqls, opportunities, customers,
               {rnd("revenue", 0)} AS won_revenue, {pct("clicks", "impressions", 2)} AS ctr_pct,
               {rnd(div("spend", "leads"), 2)} AS blended_cpl, {rnd(div("spend", "customers"), 2)} AS blended_cac,
               {pct("customers", "leads", 2)} AS lead_to_customer_pct, {rnd(div("revenue", "spend"), 2)} AS revenue_to_spend
        FROM (SELECT sum(impressions) AS impressions, sum(clicks) AS clicks, {big("sum(sessions)")} AS sessions,
                     sum(spend) AS spend FROM fact_marketing_daily),
             (SELECT count(*) AS leads, {big("sum(is_mql)")} AS mqls, {big("sum(is_sql)")} AS sqls,
                     {big("sum(has_opportunity)")} AS opportunities, {big("sum(is_customer)")} AS customers,
                     sum(won_value) AS revenue FROM v0)""",
    "q03_cost_per_lead": "SELECT channel_name, spend, leads, cpl FROM v1 WHERE spend > 0",
    "q04_payback": f"""
        SELECT channel_name, customers, cac, avg_deal_value, {rnd(div("avg_deal_value", "cac"), 2)} AS deal_value_to_cac,
               CASE WHEN cac > avg_deal_value THEN 'Pays back after year 1' WHEN cac IS NOT NULL
                    THEN 'Pays back within year 1' ELSE 'No paid spend' END AS payback
        FROM v1""",
    "q20_paid_vs_non_paid": f"""
        SELECT if(is_paid = 1, 'Paid', 'Non-paid') AS source_type, {rnd(f"sum({cents('spend')})", 0)} AS spend,
               {big("sum(leads)")} AS leads, {big("sum(customers)")} AS customers,
               {rnd(f"sum({cents('won_revenue')})", 0)} AS won_revenue,
               {pct(f"sum({cents('won_revenue')})", ALL.format(c=cents("won_revenue"), t="v1"))} AS revenue_share_pct,
               {pct("sum(customers)", "sum(leads)", 2)} AS lead_to_customer_pct,
               {rnd(div(f"sum({cents('spend')})", "sum(customers)"), 0)} AS cac
        FROM v1 GROUP BY is_paid""",
    "q14_score_by_channel": f"""
        SELECT channel_name, count(*) AS leads, count(lead_score) AS scored_leads, {rnd(mean("lead_score"), 1)} AS avg_score,
               {pct("count(*) FILTER (WHERE lead_score >= 70)", "count(lead_score)")} AS pct_high_score,
               {pct("count(*) FILTER (WHERE lead_score < 40)", "count(lead_score)")} AS pct_low_score
        FROM fact_leads JOIN dim_channel USING (channel_id) GROUP BY channel_name""",
    "q15_lead_growth": f"""
        SELECT year_month, leads, previous_month, {pct("leads - previous_month", "previous_month")} AS mom_growth_pct
        FROM (SELECT year_month, count(*) AS leads, lag(count(*)) OVER (ORDER BY year_month) AS previous_month
              FROM v0 GROUP BY year_month)""",
    "q16_revenue_growth": f"""
        SELECT year_month, won_revenue, {rnd("100.0::DOUBLE * mom_revenue", 1)} AS mom_growth_pct,
               {rnd(div(f"sum({cents('won_revenue')}) OVER three", "count(won_revenue) OVER three"), 0)} AS rolling_3m_revenue
        FROM v4 WINDOW three AS (ORDER BY year_month ROWS 2 PRECEDING)""",
    "q23_recurring_revenue": f"""
        SELECT year_month, active_customers, mrr, {rnd("mrr - lag(mrr) OVER (ORDER BY year_month)", 2)} AS net_new_mrr,
               {rnd("mrr * 12", 0)} AS arr_run_rate
        FROM v4""",
    "q24_churn_by_month": f"""
        SELECT year_month, active_customers, churned_customers, {rnd("100.0::DOUBLE * churn_rate", 2)} AS churn_rate_pct
        FROM v4""",
    "q24b_churn_by_channel": f"""
        SELECT channel_name, count(*) AS customers, {big("sum(has_churned)")} AS churned,
               {pct("sum(has_churned)", "count(*)")} AS churned_pct, {rnd(mean(cents("starting_mrr")), 2)} AS avg_starting_mrr
        FROM v6 GROUP BY channel_name""",
    "q02_funnel_by_campaign": f"""
        SELECT coalesce(campaign_name, 'Unassigned') AS campaign_name, channel_name, count(*) AS leads,
               {big("sum(is_mql)")} AS mqls, {big("sum(is_sql)")} AS sqls, {big("sum(has_opportunity)")} AS opportunities,
               {big("sum(is_customer)")} AS customers, {pct("sum(is_sql)", "count(*)")} AS lead_to_sql_pct,
               {pct("sum(is_customer)", "count(*)", 2)} AS lead_to_customer_pct
        FROM v0 JOIN dim_channel USING (channel_id) LEFT JOIN dim_campaign c ON c.campaign_id = v0.campaign_id
        GROUP BY 1, 2""",
    "q10_revenue_ranks": """
        SELECT campaign_name, channel_name, won_revenue,
               (dense_rank() OVER (ORDER BY won_revenue DESC))::INTEGER AS rank_overall,
               (dense_rank() OVER (PARTITION BY channel_name ORDER BY won_revenue DESC))::INTEGER AS rank_in_channel
        FROM v2""",
    "q17_best_campaigns": """
        SELECT campaign_name, channel_name, spend, customers, won_revenue, cac, revenue_to_spend, recommendation
        FROM v2 WHERE customers >= 5 AND spend > 0""",
    "q18_budget_waste": f"""
        SELECT campaign_name, channel_name, spend, leads, sqls, {rnd("100.0::DOUBLE * lead_to_sql_rate", 1)} AS lead_to_sql_pct,
               customers, cac, recommendation
        FROM v2
        WHERE spend > (SELECT {mean(cents("spend"), "spend > 0")} FROM v2)
          AND lead_to_sql_rate < (SELECT {div("sum(is_sql)", "count(*)")} FROM fact_leads)""",
    "q18b_budget_by_recommendation": f"""
        SELECT recommendation, count(*) AS campaigns, {rnd(f"sum({cents('spend')})", 0)} AS spend,
               {rnd(f"sum({cents('won_revenue')})", 0)} AS won_revenue,
               string_agg(campaign_name, ', ' ORDER BY campaign_name) AS campaign_list
        FROM v2 WHERE recommendation <> 'NON-PAID' GROUP BY recommendation""",
    "q17b_top_campaign_trend": f"""
        SELECT campaign_name, a.year_month, spend, sessions, coalesce(leads, 0) AS leads
        FROM (SELECT campaign_id, campaign_name, year_month, {rnd("sum(spend)", 0)} AS spend, {big("sum(sessions)")} AS sessions
              FROM fact_marketing_daily JOIN dim_date USING (date_key)
                   JOIN (SELECT campaign_id, campaign_name FROM v2 WHERE spend > 0
                         ORDER BY revenue_to_spend DESC, campaign_id LIMIT 3) USING (campaign_id)
              GROUP BY ALL) a
             LEFT JOIN (SELECT campaign_id, year_month, count(*) AS leads FROM v0 GROUP BY ALL) l
             ON l.campaign_id = a.campaign_id AND l.year_month = a.year_month""",
    "q01_full_funnel": f"""
        SELECT channel_name, sessions, leads, mqls, sqls, opportunities, customers,
               {pct("leads", "sessions", 2)} AS session_to_lead_pct, {pct("mqls", "leads")} AS lead_to_mql_pct,
               {pct("sqls", "mqls")} AS mql_to_sql_pct, {pct("customers", "sqls")} AS sql_to_customer_pct,
               {pct("customers", "leads", 2)} AS lead_to_customer_pct
        FROM v1""",
    "q05_08_stage_conversion": f"""
        SELECT stage, {big("sum(volume)")} AS volume, {pct("sum(volume)", "sum(previous_volume)")} AS conversion_from_previous_pct,
               {pct("sum(previous_volume) - sum(volume)", "sum(previous_volume)")} AS drop_off_pct
        FROM v3 GROUP BY stage""",
    "q01b_weakest_step": f"""
        SELECT channel_name, stage AS weakest_transition_into, {rnd("100.0::DOUBLE * drop_off", 1)} AS drop_off_pct
        FROM v3 WHERE stage_order > 2
        QUALIFY rank() OVER (PARTITION BY channel_name ORDER BY drop_off DESC NULLS LAST) = 1""",
    "q19_hidden_gems": f"""
        SELECT channel_name, leads, {rnd("100.0::DOUBLE * lead_to_sql_rate", 1)} AS lead_to_sql_pct,
               {rnd("100.0::DOUBLE * lead_to_customer_rate", 1)} AS lead_to_customer_pct, avg_lead_score
        FROM v1
        WHERE leads < (SELECT avg(leads) FROM v1)
          AND lead_to_sql_rate > (SELECT {div("sum(is_sql)", "count(*)")} FROM fact_leads)""",
    "q19b_volume_vs_quality": f"""
        SELECT channel_name, leads, {pct("leads", ALL.format(c="leads", t="v1"))} AS share_of_leads_pct,
               {pct("customers", ALL.format(c="customers", t="v1"))} AS share_of_customers_pct,
               {rnd("100.0::DOUBLE * lead_to_sql_rate", 1)} AS lead_to_sql_pct
        FROM v1""",
    "q14b_conversion_by_score": f"""
        SELECT CASE WHEN lead_score < 40 THEN '0-39' WHEN lead_score < 60 THEN '40-59' WHEN lead_score < 80 THEN '60-79'
                    WHEN lead_score IS NOT NULL THEN '80-100' ELSE 'Unknown' END AS score_band,
               count(*) AS leads, {pct("sum(is_mql)", "count(*)")} AS mql_pct, {pct("sum(is_sql)", "count(*)")} AS sql_pct,
               {pct("sum(is_customer)", "count(*)", 2)} AS customer_pct
        FROM v0 GROUP BY 1""",
    "q01c_conversion_trend": f"""
        SELECT year_month, count(*) AS leads, {pct("sum(is_mql)", "count(*)")} AS lead_to_mql_pct,
               {pct("sum(is_sql)", "sum(is_mql)")} AS mql_to_sql_pct, {rnd(mean("lead_score"), 1)} AS avg_score
        FROM v0 GROUP BY year_month""",
    "q09_11_revenue_pareto": f"""
        SELECT channel_name, won_revenue, {rnd("100.0::DOUBLE * revenue_share", 1)} AS revenue_share_pct,
               {rnd('''100.0::DOUBLE * (sum(revenue_share::DECIMAL(9,4)) OVER (
                       ORDER BY won_revenue DESC NULLS LAST, channel_name ROWS UNBOUNDED PRECEDING))::DOUBLE''', 1)}
               AS cumulative_share_pct
        FROM v1""",
    "q12_win_rate": f"""
        SELECT channel_name, count(*) AS closed_opportunities, count(*) FILTER (WHERE status = 'Won') AS won,
               {pct("count(*) FILTER (WHERE status = 'Won')", "count(*)")} AS win_rate_pct,
               {rnd(mean(cents("won_value"), "status = 'Won'"), 0)} AS avg_deal_value
        FROM v5 WHERE {CLOSED} GROUP BY channel_name""",
    "q13_sales_cycle": f"""
        SELECT company_size, {rnd(mean("sales_cycle_days", "status = 'Won'"), 1)} AS won_cycle_days,
               {rnd(mean("sales_cycle_days", "status = 'Lost'"), 1)} AS lost_cycle_days,
               count(sales_cycle_days) AS deals_with_known_cycle
        FROM v5 WHERE {CLOSED} GROUP BY company_size""",
    "q21_by_region": f"""
        SELECT region_group, region_name, count(*) AS leads, {big("sum(is_customer)")} AS customers,
               {pct("sum(is_customer)", "count(*)", 2)} AS lead_to_customer_pct, {rnd("sum(won_value)", 0)} AS won_revenue,
               {rnd(div("sum(won_value)", "sum(is_customer)"), 0)} AS avg_deal_value
        FROM v0 JOIN dim_region USING (region_id) GROUP BY region_group, region_name""",
    "q22_by_company_size": f"""
        SELECT company_size, count(*) AS leads, {big("sum(is_customer)")} AS customers,
               {pct("sum(is_customer)", "count(*)", 2)} AS lead_to_customer_pct,
               {rnd(div("sum(won_value)", "sum(is_customer)"), 0)} AS avg_deal_value,
               {pct("sum(won_value)", ALL.format(c="won_value", t="v0"))} AS revenue_share_pct
        FROM v0 GROUP BY company_size""",
    "q13b_value_by_status": f"""
        SELECT status, count(*) AS opportunities, {rnd(f"sum({cents('expected_value')})", 0)} AS expected_value,
               {rnd(f"sum({cents('won_value')})", 0)} AS won_value,
               {rnd(mean(cents("expected_value")), 0)} AS avg_expected_value
        FROM v5 GROUP BY status""",
    "q13c_open_value": f"""
        SELECT campaign_name, channel_name, count(*) AS open_opportunities,
               {rnd(f"sum({cents('open_pipeline_value')})", 0)} AS open_pipeline_value
        FROM v5 WHERE status = 'Open' GROUP BY ALL HAVING sum({cents('open_pipeline_value')}) > 0""",
    "q12b_plan_mix": f"""
        SELECT plan, count(*) AS customers, {rnd(mean(cents("starting_mrr")), 2)} AS avg_starting_mrr,
               {rnd(f"sum({cents('starting_mrr')})", 2)} AS starting_mrr_total,
               {pct("sum(has_churned)", "count(*)")} AS churned_pct
        FROM v6 GROUP BY plan""",
    "q23b_new_customers": f"""
        SELECT acquisition_month, if(is_paid = 1, 'Paid', 'Non-paid') AS source_type, count(*) AS new_customers,
               {rnd(f"sum({cents('starting_mrr')})", 2)} AS new_mrr
        FROM v6 JOIN dim_channel USING (channel_name) GROUP BY ALL""",
}
