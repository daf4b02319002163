"""The star schema and the seven views as SQL steps."""

from __future__ import annotations

from .compose import big, dbl, div, mean, rnd, union

YM = "'%Y-%m'"


def key_of(d: str) -> str:
    return f"strftime({d}, '%Y%m%d')::INTEGER"


TWELFTH = "((({c}) * 2 + 12) // 24 / 100.0)::DECIMAL(18,2)"

STAR = {
    "months": """
        SELECT date_trunc('month', min(d))::DATE AS first_day, last_day(max(d)) AS last_day
        FROM (SELECT o_orderdate::DATE AS d FROM orders UNION ALL SELECT l_shipdate::DATE FROM lineitem)""",
    "dim_date": f"""
        SELECT {key_of("d")} AS date_key, d AS "date", year(d)::INTEGER AS "year", 'Q' || quarter(d) AS "quarter",
               month(d)::INTEGER AS "month", strftime(d, '%b') AS month_name, strftime(d, {YM}) AS year_month,
               weekofyear(d)::INTEGER AS week, dayname(d) AS day_of_week, (isodow(d) >= 6)::INTEGER AS is_weekend
        FROM (SELECT unnest(generate_series(first_day - INTERVAL 1 MONTH, last_day(last_day + 1), INTERVAL 1 DAY))::DATE AS d
              FROM months)""",
    "known_channels": """
        SELECT * FROM (VALUES (1, 'AUTOMOBILE', 'Paid Search', 1), (2, 'BUILDING', 'Paid Social', 1),
                              (3, 'FURNITURE', 'Paid Social', 1), (4, 'HOUSEHOLD', 'Organic', 0),
                              (5, 'MACHINERY', 'Owned', 0), (6, 'DIRECT', 'Direct', 0))
                      AS t(channel_id, channel_name, channel_group, is_paid)""",
    "dim_channel": """
        SELECT * FROM known_channels
        UNION ALL SELECT (row_number() OVER (ORDER BY c_mktsegment) + 6)::INTEGER, c_mktsegment, 'Other', 0
        FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment NOT IN (SELECT channel_name FROM known_channels))""",
    "dim_campaign": """
        SELECT i::INTEGER AS campaign_id, 'Campaign ' || lpad(i::VARCHAR, 2, '0') AS campaign_name,
               ((i - 1) // 5 + 1)::INTEGER AS channel_id,
               ['Awareness', 'Leads', 'Retargeting'][i % 3 + 1] AS objective, DATE '1995-01-01' AS start_date
        FROM range(1, 27) AS r(i)""",
    "dim_region": """
        SELECT n_nationkey::INTEGER AS region_id, n_name AS region_name, r_name AS region_group
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "lead_base": """
        SELECT o_orderkey AS lead_id, o_orderdate::DATE AS created, channel_id, channel_name,
               CASE WHEN o_orderkey % 100 <> 0 AND channel_id <= 5 THEN ((channel_id - 1) * 5 + c_custkey % 5 + 1)::INTEGER END AS campaign_id,
               c_nationkey::INTEGER AS region_id,
               CASE WHEN c_custkey % 10 < 6 THEN '1-9' WHEN c_custkey % 10 < 9 THEN '10-49' ELSE '50+' END AS company_size,
               o_orderpriority AS business_type, floor(c_acctbal / 100)::INTEGER AS lead_score,
               (o_orderpriority < '4')::INTEGER AS is_mql, (o_totalprice > 350000)::INTEGER AS is_sql
        FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN dim_channel ON c_mktsegment = channel_name""",
    "order_lines": """
        SELECT l_orderkey, max(l_shipdate)::DATE AS last_ship,
               sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(18,2) AS line_value
        FROM lineitem GROUP BY l_orderkey""",
    "opportunity_base": """
        SELECT o_orderkey AS opportunity_id, o_orderkey - (o_orderkey % 200 = 1)::BIGINT AS lead_id,
               o_orderdate::DATE AS created, CASE WHEN o_orderstatus IN ('F', 'P') THEN last_ship END AS closed,
               CASE o_orderstatus WHEN 'F' THEN 'Won' WHEN 'P' THEN 'Lost' ELSE 'Open' END AS status,
               ['Starter', 'Pro', 'Group'][o_orderkey % 3 + 1] AS plan, (1 + o_orderkey % 5)::INTEGER AS sites,
               o_totalprice::DECIMAL(18,2) AS expected_value,
               CASE WHEN o_orderstatus = 'F' THEN coalesce(line_value, 0) ELSE 0 END::DECIMAL(18,2) AS won_value
        FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey WHERE o_totalprice > 350000""",
    "monthly_lines": f"""
        SELECT l_orderkey AS customer_id, strftime(l_shipdate, {YM}) AS year_month, bool_or(l_returnflag = 'R') AS returned,
               {TWELFTH.format(c="(sum(l_extendedprice::DECIMAL(18,2)) * 100)::BIGINT")} AS mrr
        FROM lineitem GROUP BY ALL""",
    "billing_base": """
        SELECT customer_id, year_month, mrr,
               CASE WHEN returned AND year_month = max(year_month) OVER (PARTITION BY customer_id)
                    THEN 'churned' ELSE 'active' END AS status
        FROM monthly_lines""",
    "marketing_base": """
        SELECT "day", campaign_id, channel_id, clicks * 20 AS impressions, clicks, sessions,
               CASE WHEN channel_id <= 3
                    THEN (cost * (0.75::DECIMAL(4,2) * (campaign_id % 5 + 1))::DECIMAL(4,2))::DECIMAL(18,2)
                    ELSE 0 END::DECIMAL(18,2) AS spend
        FROM (SELECT *, ((campaign_id - 1) // 5 + 1)::INTEGER AS channel_id
              FROM (SELECT l_shipdate::DATE AS "day", (l_partkey % 25 + 1)::INTEGER AS campaign_id,
                           sum(l_quantity::BIGINT)::BIGINT AS clicks, count(*) AS sessions,
                           sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DECIMAL(18,2) AS cost
                    FROM lineitem GROUP BY ALL))""",
    "fact_marketing_daily": f"""
        SELECT {key_of('"day"')} AS date_key, campaign_id, channel_id, impressions, clicks, sessions, spend
        FROM marketing_base""",
    "fact_leads": f"""
        SELECT lead_id, {key_of("created")} AS created_date_key, channel_id, campaign_id, region_id, company_size,
               business_type, CASE WHEN lead_score BETWEEN 0 AND 100 THEN lead_score END AS lead_score,
               greatest(is_mql, is_sql) AS is_mql, is_sql
        FROM lead_base""",
    "opportunity_clean": """
        SELECT * REPLACE (CASE WHEN closed < created THEN NULL ELSE closed END AS closed,
                          CASE WHEN status = 'Won' AND won_value <= 0 THEN expected_value ELSE won_value END AS won_value),
               (status = 'Won' AND won_value <= 0)::INTEGER AS value_imputed
        FROM opportunity_base""",
    "fact_opportunities": f"""
        SELECT opportunity_id, lead_id, {key_of("o.created")} AS created_date_key, {key_of("o.closed")} AS close_date_key,
               channel_id, campaign_id, region_id, company_size, plan, sites, status,
               (status = 'Won')::INTEGER AS is_won, expected_value, won_value,
               (o.closed - o.created)::INTEGER AS sales_cycle_days, value_imputed
        FROM opportunity_clean o JOIN lead_base USING (lead_id)""",
    "dim_customer": f"""
        SELECT opportunity_id AS customer_id, opportunity_id, lead_id,
               coalesce(close_date_key, o.created_date_key) AS acquisition_date_key, o.channel_id, o.campaign_id, o.region_id,
               o.company_size, l.business_type, plan, {TWELFTH.format(c="(won_value * 100)::BIGINT")} AS starting_mrr
        FROM fact_opportunities o JOIN fact_leads l USING (lead_id) WHERE is_won = 1""",
    "fact_customer_monthly": """
        SELECT customer_id, year_month, replace(year_month || '-01', '-', '')::INTEGER AS month_key, mrr,
               (status = 'active')::INTEGER AS is_active, (status = 'churned')::INTEGER AS is_churned
        FROM billing_base
        WHERE customer_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 350000)""",
}

FILLED = ["sessions", "spend", "leads", "mqls", "sqls", "opportunities", "customers", "won_revenue"]


def _funnel_totals(by: str, where: str = "TRUE") -> str:
    return f"""
        SELECT {by}, count(*) AS leads, {big("sum(is_mql)")} AS mqls, {big("sum(is_sql)")} AS sqls,
               {big("sum(has_opportunity)")} AS opportunities, {big("sum(is_customer)")} AS customers,
               sum(won_value)::DOUBLE AS won_revenue, {mean("lead_score")} AS score_mean,
               {mean("won_cycle_days")} AS cycle_mean
        FROM v0 WHERE {where} GROUP BY {by}"""


def _activity(by: str) -> str:
    return f"""
        SELECT {by}, {big("sum(impressions)")} AS impressions, {big("sum(clicks)")} AS clicks,
               {big("sum(sessions)")} AS sessions, sum(spend)::DOUBLE AS spend
        FROM fact_marketing_daily GROUP BY {by}"""


_PAID_SPEND = "nullif(spend, 0)"
_RATE = div("sqls", "leads")
_ROI = div("won_revenue", "spend")
_STAGES = ["sessions", "leads", "mqls", "sqls", "opportunities", "customers"]
_STAGE_NAMES = ["Sessions", "Leads", "MQL", "SQL", "Opportunity", "Customer"]

VIEWS = {
    "v0_per_lead": f"""
        SELECT lead_id, count(*) AS n, max(is_won) AS won, sum(won_value) FILTER (WHERE is_won = 1) AS won_sum,
               {mean("sales_cycle_days", "is_won = 1")} AS won_cycle_days
        FROM fact_opportunities GROUP BY lead_id""",
    "v0": """
        SELECT l.lead_id, created_date_key, year_month, channel_id, campaign_id, region_id, company_size, business_type,
               lead_score, is_mql, is_sql, (n IS NOT NULL)::INTEGER AS has_opportunity, coalesce(won, 0) AS is_customer,
               coalesce(won_sum, 0) AS won_value, won_cycle_days
        FROM fact_leads l JOIN dim_date ON date_key = created_date_key LEFT JOIN v0_per_lead USING (lead_id)""",
    "v1_activity": _activity("channel_id"),
    "v1_funnel": _funnel_totals("channel_id"),
    "v1": f"""
        SELECT channel_id, channel_name, channel_group, is_paid, impressions, clicks, sessions, spend,
               leads, mqls, sqls, opportunities, customers, won_revenue,
               {rnd("score_mean", 1)} AS avg_lead_score, {rnd("cycle_mean", 1)} AS avg_sales_cycle_days,
               {rnd(div("clicks", "impressions"), 4)} AS ctr, {rnd(div("spend", "clicks"), 2)} AS cpc,
               {rnd(div("leads", "sessions"), 4)} AS session_to_lead_rate, {rnd(_RATE, 4)} AS lead_to_sql_rate,
               {rnd(div("customers", "leads"), 4)} AS lead_to_customer_rate,
               {rnd(div(_PAID_SPEND, "leads"), 2)} AS cpl, {rnd(div(_PAID_SPEND, "customers"), 2)} AS cac,
               {rnd(_ROI, 2)} AS revenue_to_spend, {rnd(div("won_revenue", "customers"), 2)} AS avg_deal_value,
               {rnd(div("won_revenue", "(SELECT sum(won_value) FROM v0)"), 4)} AS revenue_share
        FROM dim_channel LEFT JOIN v1_activity USING (channel_id) LEFT JOIN v1_funnel USING (channel_id)""",
    "v2_activity": _activity("campaign_id"),
    "v2_funnel": _funnel_totals("campaign_id", "campaign_id IS NOT NULL"),
    "v2_filled": f"""
        SELECT campaign_id, campaign_name, channel_name, is_paid, objective, score_mean, {_RATE} AS rate,
               avg({_RATE}) OVER (PARTITION BY channel_id) AS sibling_rate,
               {", ".join(f"coalesce({c}, 0) AS {c}" for c in FILLED)}
        FROM dim_campaign JOIN dim_channel USING (channel_id)
             LEFT JOIN v2_activity USING (campaign_id) LEFT JOIN v2_funnel USING (campaign_id)""",
    "v2": f"""
        SELECT campaign_id, campaign_name, channel_name, objective, {", ".join(FILLED)},
               {rnd("score_mean", 1)} AS avg_lead_score, {rnd("rate", 4)} AS lead_to_sql_rate,
               {rnd(div("customers", "leads"), 4)} AS lead_to_customer_rate,
               {rnd(div(_PAID_SPEND, "leads"), 2)} AS cpl, {rnd(div(_PAID_SPEND, "customers"), 2)} AS cac,
               {rnd(_ROI, 2)} AS revenue_to_spend,
               CASE WHEN is_paid = 0 THEN 'NON-PAID' WHEN {_ROI} >= 1.5 AND rate >= sibling_rate THEN 'SCALE'
                    WHEN {_ROI} >= 1 THEN 'MAINTAIN' WHEN {_ROI} >= 0.5 THEN 'OPTIMISE' ELSE 'REDUCE' END AS recommendation,
               (dense_rank() OVER (ORDER BY won_revenue DESC))::INTEGER AS revenue_rank
        FROM v2_filled""",
    "v3_long": union(
        [
            f"SELECT channel_name, {i} AS stage_order, '{name}' AS stage, {column} AS volume FROM v1"
            for i, (name, column) in enumerate(zip(_STAGE_NAMES, _STAGES), 1)
        ]
    ),
    "v3_steps": """
        SELECT *, lag(volume) OVER (PARTITION BY channel_name ORDER BY stage_order) AS previous_volume FROM v3_long""",
    "v3": f"""
        SELECT *, {rnd(div("volume", "previous_volume"), 4)} AS conversion_from_previous,
               {rnd("1.0::DOUBLE - " + div("volume", "previous_volume"), 4)} AS drop_off
        FROM v3_steps""",
    "v4_activity": f"""
        SELECT year_month, {big("sum(sessions)")} AS sessions, sum(spend)::DOUBLE AS spend
        FROM fact_marketing_daily JOIN dim_date USING (date_key) GROUP BY year_month""",
    "v4_leads": f"""
        SELECT year_month, count(*) AS leads, {big("sum(is_mql)")} AS mqls, {big("sum(is_sql)")} AS sqls
        FROM v0 GROUP BY year_month""",
    "v4_won": """
        SELECT year_month, count(*) AS customers, sum(won_value)::DOUBLE AS won_revenue
        FROM fact_opportunities JOIN dim_date ON date_key = coalesce(close_date_key, created_date_key)
        WHERE is_won = 1 GROUP BY year_month""",
    "v4_recurring": f"""
        SELECT year_month, coalesce(sum(mrr) FILTER (WHERE is_active = 1), 0)::DOUBLE AS mrr,
               {big("sum(is_active)")} AS active_customers, {big("sum(is_churned)")} AS churned_customers
        FROM fact_customer_monthly GROUP BY year_month""",
    "v4_filled": f"""
        SELECT year_month, {", ".join(f"coalesce({c}, 0) AS {c}" for c in
               ["sessions", "spend", "leads", "mqls", "sqls", "customers", "won_revenue", "mrr",
                "active_customers", "churned_customers"])}
        FROM (SELECT DISTINCT year_month FROM dim_date WHERE date_key BETWEEN (SELECT strftime(first_day, '%Y%m%d')::INTEGER FROM months) AND (SELECT strftime(last_day, '%Y%m%d')::INTEGER FROM months))
             LEFT JOIN v4_activity USING (year_month) LEFT JOIN v4_leads USING (year_month)
             LEFT JOIN v4_won USING (year_month) LEFT JOIN v4_recurring USING (year_month)""",
    "v4_before": """
        SELECT *, lag(leads) OVER (ORDER BY year_month) AS leads_before,
               lag(won_revenue) OVER (ORDER BY year_month) AS revenue_before FROM v4_filled""",
    "v4": f"""
        SELECT * EXCLUDE (leads_before, revenue_before), {rnd(div("spend", "leads"), 2)} AS cpl,
               {rnd(div("spend", "customers"), 2)} AS blended_cac,
               {rnd(div("churned_customers", "active_customers + churned_customers"), 4)} AS churn_rate,
               {rnd(div("leads - leads_before", "leads_before"), 4)} AS mom_leads,
               {rnd(div("won_revenue - revenue_before", "revenue_before"), 4)} AS mom_revenue
        FROM v4_before""",
    "v5": f"""
        SELECT opportunity_id, channel_name, coalesce(campaign_name, 'Unassigned') AS campaign_name, region_name,
               company_size, plan, sites, status, c.year_month AS created_month, x.year_month AS close_month,
               {dbl("expected_value")} AS expected_value, {dbl("won_value")} AS won_value,
               CASE WHEN status = 'Open' THEN expected_value ELSE 0 END::DOUBLE AS open_pipeline_value,
               CASE WHEN status = 'Lost' THEN expected_value ELSE 0 END::DOUBLE AS lost_value,
               sales_cycle_days, value_imputed
        FROM fact_opportunities o JOIN dim_channel USING (channel_id) JOIN dim_region USING (region_id)
             LEFT JOIN dim_campaign g ON g.campaign_id = o.campaign_id
             JOIN dim_date c ON c.date_key = created_date_key LEFT JOIN dim_date x ON x.date_key = close_date_key""",
    "v6_history": """
        SELECT customer_id, count(*) AS months_billed, sum(mrr)::DOUBLE AS revenue_to_date,
               max(is_churned) AS has_churned, max(year_month) AS last_month
        FROM fact_customer_monthly GROUP BY customer_id""",
    "v6": f"""
        SELECT customer_id, channel_name, region_name, region_group, company_size, business_type, plan,
               year_month AS acquisition_month, {dbl("starting_mrr")} AS starting_mrr, months_billed, revenue_to_date,
               has_churned, last_month
        FROM dim_customer JOIN dim_channel USING (channel_id) JOIN dim_region USING (region_id)
             JOIN dim_date ON date_key = acquisition_date_key LEFT JOIN v6_history USING (customer_id)""",
}

STEPS = {**STAR, **VIEWS}
