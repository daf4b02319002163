"""Expected values of the measures, the report model and the report datasets."""

from __future__ import annotations

from .clean import CLEAN_STAR_STEPS, REPORT_STEPS
from .compose import dbl, div, rnd

_JOINS = """LEFT JOIN dim_channel USING (channel_id)
            LEFT JOIN m_campaign ON m_campaign.campaign_id = coalesce({t}.campaign_id, 0)"""
_NAMES = "channel_name, is_paid, campaign_name, recommendation"

_ROI = "coalesce(revenue / nullif(spend, 0), 0)"
MODEL_STEPS = {
    "m_advice": f"""
        SELECT campaign_id, CASE WHEN is_paid = 0 THEN 'NON-PAID' WHEN {_ROI} >= 1.5 AND coalesce(rate, 0) >= peers THEN 'SCALE'
                                 WHEN {_ROI} >= 1.0 THEN 'MAINTAIN' WHEN {_ROI} >= 0.5 THEN 'OPTIMISE' ELSE 'REDUCE' END AS advice
        FROM (SELECT campaign_id, is_paid, spend, revenue, rate,
                     coalesce(avg(rate) OVER (PARTITION BY channel_id), 0) AS peers
              FROM dim_campaign JOIN dim_channel USING (channel_id)
                   LEFT JOIN (SELECT campaign_id, {div("sum(is_sql)", "count(*)")} AS rate FROM fact_leads GROUP BY 1)
                        USING (campaign_id)
                   LEFT JOIN (SELECT campaign_id, {dbl("sum(spend)")} AS spend FROM fact_marketing_daily GROUP BY 1)
                        USING (campaign_id)
                   LEFT JOIN (SELECT campaign_id, {dbl("sum(won_value)")} AS revenue FROM fact_opportunities
                              WHERE is_won = 1 GROUP BY 1) USING (campaign_id))""",
    "m_campaign": """
        SELECT campaign_id, campaign_name, channel_id AS home_channel, objective, start_date, advice AS recommendation
        FROM dim_campaign LEFT JOIN m_advice USING (campaign_id)
        UNION ALL SELECT 0, 'Unassigned', NULL, 'Unknown', NULL, 'UNASSIGNED'""",
    "f_marketing": f"""
        SELECT f.*, year_month, "year", {_NAMES} FROM fact_marketing_daily f JOIN dim_date USING (date_key)
               {_JOINS.format(t="f")}""",
    "f_leads": f"""
        SELECT f.*, year_month, "year", region_name, {_NAMES},
               strftime(strptime(year_month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH, '%Y-%m') AS next_month
        FROM fact_leads f JOIN dim_date ON date_key = created_date_key LEFT JOIN dim_region USING (region_id)
             {_JOINS.format(t="f")}""",
    "f_deals": f"""
        SELECT f.*, year_month, "year", region_name, {_NAMES},
               strftime(strptime(year_month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH, '%Y-%m') AS next_month
        FROM fact_opportunities f JOIN dim_date ON date_key = coalesce(close_date_key, created_date_key)
             LEFT JOIN dim_region USING (region_id) {_JOINS.format(t="f")}""",
    "f_monthly": f"""
        SELECT f.*, "year", region_name, company_size, business_type, {_NAMES}
        FROM fact_customer_monthly f JOIN dim_date ON date_key = month_key JOIN dim_customer c USING (customer_id)
             LEFT JOIN dim_region USING (region_id) {_JOINS.format(t="c")}""",
}

STEPS = {**CLEAN_STAR_STEPS, **REPORT_STEPS, **MODEL_STEPS}


def _n(where: str = "TRUE") -> str:
    return f"nullif(count(*) FILTER (WHERE {where}), 0)"


def _s(column: str, where: str = "TRUE") -> str:
    return f"(sum({column}) FILTER (WHERE {where}))"


PARTS = {
    "f_marketing": {
        "spend": dbl(_s("spend")), "impressions": _s("impressions"), "clicks": _s("clicks"), "sessions": _s("sessions"),
        "paid_spend": dbl(_s("spend", "is_paid = 1")),
    },
    "f_leads": {
        "leads": _n(), "mqls": _n("is_mql = 1"), "sqls": _n("is_sql = 1"),
        "score": div("sum(lead_score)", "count(lead_score)"),
    },
    "f_deals": {
        "deals": _n(), "customers": _n("is_won = 1"), "closed": _n("status IN ('Won', 'Lost')"),
        "revenue": dbl(_s("won_value", "is_won = 1")), "paid_customers": _n("is_won = 1 AND is_paid = 1"),
        "free_revenue": dbl(_s("won_value", "is_won = 1 AND is_paid = 0")),
        "cycle": div(_s("sales_cycle_days", "is_won = 1"), "count(sales_cycle_days) FILTER (WHERE is_won = 1)"),
        "open_value": dbl(_s("expected_value", "status = 'Open'")),
        "lost_value": dbl(_s("expected_value", "status = 'Lost'")),
    },
    "f_monthly": {
        "mrr": dbl(_s("mrr", "is_active = 1")),
        "mrr_end": dbl(_s("mrr", "is_active = 1 AND month_key = last_key")),
        "active": "nullif(count(DISTINCT customer_id) FILTER (WHERE is_active = 1), 0)",
        "churned": _s("is_churned"),
    },
}

B = "::BIGINT"
FORMULAS = {
    "total_spend": "spend", "impressions": "impressions" + B, "clicks": "clicks" + B, "sessions": "sessions" + B,
    "ctr": div("clicks", "impressions"), "cpc": div("spend", "clicks"), "leads": "leads", "mqls": "mqls", "sqls": "sqls",
    "avg_lead_score": "score", "opportunities": "deals", "customers": "customers",
    "session_to_lead_rate": div("leads", "sessions"), "lead_to_mql_rate": div("mqls", "leads"),
    "mql_to_sql_rate": div("sqls", "mqls"), "sql_to_customer_rate": div("customers", "sqls"),
    "lead_to_customer_rate": div("customers", "leads"), "cpl": f"CASE WHEN spend > 0 THEN {div('spend', 'leads')} END",
    "cac": f"CASE WHEN spend > 0 THEN {div('spend', 'customers')} END", "revenue_per_spend": div("revenue", "spend"),
    "won_revenue": "revenue", "average_deal_value": div("revenue", "customers"), "average_sales_cycle": "cycle",
    "win_rate": div("customers", "closed"), "open_pipeline": "open_value", "lost_value": "lost_value", "mrr": "mrr",
    "mrr_end_of_period": "mrr_end", "active_customers": "active", "churned_customers": "churned" + B,
    "churn_rate": div("churned", "coalesce(active, 0) + coalesce(churned, 0)"), "paid_spend": "paid_spend",
    "paid_cac": f"CASE WHEN paid_spend > 0 THEN {div('paid_spend', 'paid_customers')} END",
    "non_paid_revenue_share": div("free_revenue", "revenue"), "arr_run_rate": "mrr_end * 12",
    "share_of_leads": div("leads", "all_leads"), "share_of_customers": div("customers", "all_customers"),
    "mom_leads": div("coalesce(leads, 0) - leads_before", "leads_before"),
    "mom_revenue": div("coalesce(revenue, 0) - revenue_before", "revenue_before"),
}
for _m, _src, _expr in [
    ("issues_found_raw", "dq_results", "sum(raw)"),
    ("blocking_errors_left", "dq_results", "sum(clean) FILTER (WHERE severity = 'BLOCKING')"),
    ("documented_warnings", "dq_results", "sum(clean) FILTER (WHERE severity = 'WARNING')"),
    ("issues_after_cleaning", "dq_results", "sum(clean)"),
    ("rows_loaded", "dq_rows", "sum(clean_rows)"),
    ("rows_removed", "dq_rows", "sum(removed)"),
    ("campaigns_to_scale", "m_campaign", "count(*) FILTER (WHERE recommendation = 'SCALE')"),
    ("campaigns_to_reduce", "m_campaign", "count(*) FILTER (WHERE recommendation = 'REDUCE')"),
]:
    FORMULAS[_m] = f"(SELECT {_expr} FROM {_src}){B}"


def grouped(fact: str, by: list[str], where: str = "TRUE") -> str:
    keys = "".join(f"{c}, " for c in by)
    parts = ", ".join(f"{e} AS {p}" for p, e in PARTS[fact].items())
    source = f"(SELECT * FROM {fact} WHERE {where})"
    if fact == "f_monthly":
        window = f"PARTITION BY {', '.join(by)}" if by else ""
        source = f"(SELECT *, max(month_key) OVER ({window}) AS last_key FROM f_monthly WHERE {where})"
    return f"SELECT {keys}{parts} FROM {source}" + (f" GROUP BY {', '.join(by)}" if by else "")


def evaluated(measures: list[str], by: list[str], extra: str = "") -> str:
    """Measures over a grouping, without rows in which all are blank; ``extra`` joins further steps by the grouping columns."""
    sql = _evaluated(measures, by, extra)
    return _not_blank(sql, measures) if by else sql


def _not_blank(sql: str, measures: list[str]) -> str:
    return f"SELECT * FROM ({sql}) WHERE NOT ({' AND '.join(f'{m} IS NULL' for m in measures)})"


def _evaluated(measures: list[str], by: list[str], extra: str = "") -> str:
    def uses(name: str) -> bool:
        import re

        return any(re.search(rf"\b{name}\b", FORMULAS[m]) for m in measures)

    facts = [f for f, parts in PARTS.items() if any(uses(p) for p in parts)]
    source = f"({grouped(facts[0], by)})" if facts else "(SELECT 1)"
    for f in facts[1:]:
        source += f" FULL JOIN ({grouped(f, by)}) USING ({', '.join(by)})" if by else f", ({grouped(f, by)})"
    if uses("all_leads"):
        wide = [c for c in by if c != "channel_name"]
        keys, using = "".join(f"{c}, " for c in wide), f"USING ({', '.join(wide)})"
        for part, fact in [("count(*) AS all_leads", "f_leads"), (f"{_n('is_won = 1')} AS all_customers", "f_deals")]:
            totals = f"(SELECT {keys}{part} FROM {fact}{' GROUP BY ALL' if wide else ''})"
            source += f" LEFT JOIN {totals} {using}" if wide else f", {totals}"
    columns = [*by, *[f"{FORMULAS[m]} AS {m}" for m in measures]]
    return f"SELECT {', '.join(columns)} FROM {source} {extra}"


MONTHS = "(SELECT DISTINCT year_month FROM dim_date)"
_BEFORE = f"""
    FULL JOIN (SELECT next_month AS year_month, count(*) AS leads_before FROM f_leads
               WHERE next_month IN {MONTHS} GROUP BY 1) USING (year_month)
    FULL JOIN (SELECT next_month AS year_month, {dbl(_s("won_value", "is_won = 1"))} AS revenue_before FROM f_deals
               WHERE next_month IN {MONTHS} GROUP BY 1) USING (year_month)"""


def by_month(measures: list[str]) -> str:
    sql = _evaluated([m for m in measures if not m.startswith(("share_", "mom_"))], ["year_month"])
    head, tail = sql.split(" FROM ", 1)
    more = ", ".join(f"{FORMULAS[m]} AS {m}" for m in measures if m.startswith(("share_", "mom_")))
    totals = """LEFT JOIN (SELECT year_month, count(*) AS all_leads FROM f_leads GROUP BY 1) USING (year_month)
                LEFT JOIN (SELECT year_month, count(*) FILTER (WHERE is_won = 1) AS all_customers FROM f_deals GROUP BY 1)
                     USING (year_month)"""
    return _not_blank(f"{head}, {more} FROM {tail} {_BEFORE} {totals}", measures)


_KEEP = """ "year" = 1998 AND channel_name IN ('BUILDING', 'FURNITURE', 'MACHINERY') """
_IN = "channel_name IN ('BUILDING', 'FURNITURE', 'MACHINERY')"
FILTERED = f"""
    SELECT year_month, channel_name, leads, customers, {FORMULAS["share_of_leads"]} AS share_of_leads,
           {FORMULAS["share_of_customers"]} AS share_of_customers, {FORMULAS["mom_leads"]} AS mom_leads,
           mrr_end AS mrr_end_of_period, paid_spend
    FROM ({grouped("f_leads", ["year_month", "channel_name"], _KEEP)})
         FULL JOIN ({grouped("f_deals", ["year_month", "channel_name"], _KEEP)}) USING (year_month, channel_name)
         FULL JOIN ({grouped("f_monthly", ["year_month", "channel_name"], _KEEP)}) USING (year_month, channel_name)
         FULL JOIN (SELECT year_month, channel_name, paid_spend
                    FROM ({grouped("f_marketing", ["year_month", "channel_name"], _KEEP)}) WHERE paid_spend IS NOT NULL)
              USING (year_month, channel_name)
         FULL JOIN (SELECT next_month AS year_month, channel_name, count(*) AS leads_before FROM f_leads
                    WHERE {_IN} AND next_month LIKE '1998%' GROUP BY ALL) USING (year_month, channel_name)
         LEFT JOIN (SELECT year_month, count(*) AS all_leads FROM f_leads GROUP BY 1) USING (year_month)
         LEFT JOIN (SELECT year_month, count(*) FILTER (WHERE is_won = 1) AS all_customers FROM f_deals GROUP BY 1)
              USING (year_month)"""

MODEL_TABLES = {
    "DimDate": """SELECT * REPLACE ("date"::VARCHAR AS "date") FROM dim_date""",
    "DimChannel": "SELECT *, channel_id AS sort_order FROM dim_channel",
    "DimCampaign": "SELECT * REPLACE (start_date::VARCHAR AS start_date) RENAME (home_channel AS channel_id) FROM m_campaign",
    "DimRegion": "SELECT * FROM dim_region",
    "DimCustomer": """
        SELECT * EXCLUDE (lead_id) REPLACE (ifnull(campaign_id, 0) AS campaign_id, starting_mrr::DOUBLE AS starting_mrr)
        FROM dim_customer""",
    "FactMarketingDaily": "SELECT * REPLACE (spend::DOUBLE AS spend) FROM fact_marketing_daily",
    "FactLeads": """
        SELECT * REPLACE (ifnull(campaign_id, 0) AS campaign_id),
               CASE WHEN lead_score < 40 THEN '0-39' WHEN lead_score < 60 THEN '40-59' WHEN lead_score < 80 THEN '60-79'
                    WHEN lead_score >= 80 THEN '80-100' ELSE 'Unknown' END AS score_band
        FROM fact_leads""",
    "FactOpportunities": """
        SELECT * REPLACE (ifnull(campaign_id, 0) AS campaign_id, expected_value::DOUBLE AS expected_value,
                          won_value::DOUBLE AS won_value),
               ifnull(close_date_key, created_date_key) AS revenue_date_key
        FROM fact_opportunities""",
    "FactCustomerMonthly": "SELECT * REPLACE (mrr::DOUBLE AS mrr) FROM fact_customer_monthly",
    "DataQualityChecks": "SELECT * EXCLUDE (status) FROM dq_results",
    "DataQualityRowCounts": "FROM dq_rows",
    "CleaningLog": "FROM dq_log",
}

FUNNEL = ["leads", "mqls", "sqls", "opportunities", "customers"]
RATES = ["session_to_lead_rate", "lead_to_mql_rate", "mql_to_sql_rate", "sql_to_customer_rate", "lead_to_customer_rate"]
CH, MO, CA = ["channel_name"], ["year_month"], ["campaign_name"]
PLAIN_DATASETS = {
    "rd01": (["total_spend", "leads", "customers", "won_revenue", "cac", "lead_to_customer_rate"], []),
    "rd02": (["sessions", *FUNNEL], []),
    "rd03": (["paid_spend", "paid_cac", "non_paid_revenue_share", "campaigns_to_scale", "campaigns_to_reduce"], []),
    "rd04": (["won_revenue", "win_rate", "average_deal_value", "average_sales_cycle", "open_pipeline"], []),
    "rd05": (["customers", "mrr_end_of_period", "arr_run_rate", "churned_customers", "churn_rate"], []),
    "rd06": (["rows_loaded", "rows_removed", "issues_found_raw", "blocking_errors_left", "documented_warnings"], []),
    "rd11": (["won_revenue", "leads"], MO),
    "rd12": (["won_revenue"], CH),
    "rd13": (FUNNEL, []),
    "rd14": (["share_of_leads", "share_of_customers"], CH),
    "rd22": (RATES, CH),
    "rd24": (["avg_lead_score"], CH),
    "rd31": (["cac", "won_revenue", "leads"], ["campaign_name", "recommendation"]),
    "rd32": (["total_spend", "leads", "cpl", "cac", "won_revenue", "revenue_per_spend"], CH),
    "rd41": (["won_revenue"], MO),
    "rd42": (["opportunities"], ["channel_name", "status"]),
    "rd43": (["average_sales_cycle"], ["company_size"]),
    "rd44": (["average_deal_value"], ["company_size"]),
    "rd45": (["open_pipeline"], CA),
    "rd51": (["churned_customers", "mrr"], MO),
    "rd52": (["customers"], CH),
    "rd53": (["customers"], ["region_name"]),
    "rd54": (["mrr_end_of_period"], ["company_size"]),
    "rd55": (["mrr_end_of_period"], ["business_type"]),
}

_VOLUMES = evaluated(FUNNEL, [])
_OPEN = evaluated(["open_pipeline"], CA)
REPORT_QUERIES = {
    **{f"model_{n}": sql for n, sql in MODEL_TABLES.items()},
    **{n: evaluated(m, by) for n, (m, by) in PLAIN_DATASETS.items()},
    "rd21": f"""
        SELECT stage_order, stage, volume, {div("volume", "lag(volume) OVER (ORDER BY stage_order)")} AS share_of_previous
        FROM (SELECT generate_subscripts(s, 1)::INTEGER AS stage_order, unnest(s) AS stage, unnest(v) AS volume
              FROM (SELECT {FUNNEL} AS s, [{", ".join(FUNNEL)}] AS v FROM ({_VOLUMES})))""",
    "rd23": f"""
        SELECT CASE WHEN lead_score < 40 THEN '0-39' WHEN lead_score < 60 THEN '40-59' WHEN lead_score < 80 THEN '60-79'
                    WHEN lead_score >= 80 THEN '80-100' ELSE 'Unknown' END AS score_band,
               {div("sum(is_customer)", "count(*)")} AS lead_to_customer_rate
        FROM v0 GROUP BY 1""",
    "rd23_sliced": f"""
        SELECT CASE WHEN lead_score < 40 THEN '0-39' WHEN lead_score < 60 THEN '40-59' WHEN lead_score < 80 THEN '60-79'
                    WHEN lead_score >= 80 THEN '80-100' ELSE 'Unknown' END AS score_band,
               {div("sum(is_customer)", "count(*)")} AS lead_to_customer_rate
        FROM v0 JOIN dim_channel USING (channel_id) WHERE is_paid = 1 AND year_month BETWEEN '1996-01' AND '1996-12' GROUP BY 1""",
    "rd61": """
        SELECT description, sum(raw)::BIGINT AS issues_found_raw, sum(clean)::BIGINT AS issues_after_cleaning
        FROM dq_results GROUP BY description""",
    "rd62": "FROM dq_rows",
    "rd63": "FROM dq_log",
    "rd_channel_rank": f"""
        SELECT *, (rank() OVER (ORDER BY won_revenue DESC NULLS LAST))::INTEGER AS revenue_rank
        FROM ({evaluated(["won_revenue"], CH)})""",
    "rd_revenue_trend": f"""
        SELECT *, {div("sum(won_revenue::DECIMAL(38,2)) OVER w", "count(won_revenue) OVER w")} AS three_month_mean
        FROM ({evaluated(["won_revenue"], MO)}) WINDOW w AS (ORDER BY year_month ROWS 2 PRECEDING)""",
    "rd_biggest_open": f"SELECT * FROM ({_OPEN}) ORDER BY open_pipeline DESC NULLS LAST, campaign_name LIMIT 6",
}


# ------------------------------------------------------------------ reconciliation and summary
WHOLE = [
    "total_spend", "impressions", "clicks", "sessions", "ctr", "cpc", "leads", "mqls", "sqls", "avg_lead_score",
    "opportunities", "customers", "session_to_lead_rate", "lead_to_mql_rate", "mql_to_sql_rate", "sql_to_customer_rate",
    "lead_to_customer_rate", "cpl", "cac", "won_revenue", "revenue_per_spend", "average_deal_value",
    "average_sales_cycle", "win_rate", "open_pipeline", "lost_value", "mrr", "mrr_end_of_period", "active_customers",
    "churned_customers", "churn_rate", "issues_found_raw", "blocking_errors_left", "documented_warnings", "rows_loaded",
    "rows_removed",
]
_CHANNEL = ["leads", "customers", "won_revenue", "cpl", "cac", "win_rate"]
_MONTH = ["leads", "mom_leads", "mom_revenue"]

# the same whole-period figures, this time one by one from the facts
_F = {"m": "fact_marketing_daily", "l": "fact_leads", "o": "fact_opportunities", "b": "fact_customer_monthly"}


def _of(table: str, expr: str, where: str = "TRUE") -> str:
    return f"(SELECT {expr} FROM {_F[table]} WHERE {where})"


_SP, _LE, _CU = _of("m", "sum(spend)"), _of("l", "count(*)"), _of("o", "sum(is_won)")
_RE, _SE = _of("o", "sum(won_value)", "is_won = 1"), _of("m", "sum(sessions)")
_MQ, _SQ = _of("l", "sum(is_mql)"), _of("l", "sum(is_sql)")
_CL = _of("o", "count(*)", "status IN ('Won', 'Lost')")
_AC, _CHN = _of("b", "count(DISTINCT customer_id)", "is_active = 1"), _of("b", "sum(is_churned)")
DIRECT = {
    "total_spend": _SP, "impressions": _of("m", "sum(impressions)"), "clicks": _of("m", "sum(clicks)"), "sessions": _SE,
    "ctr": _of("m", div("sum(clicks)", "sum(impressions)")), "cpc": _of("m", div("sum(spend)", "sum(clicks)")),
    "leads": _LE, "mqls": _MQ, "sqls": _SQ, "avg_lead_score": _of("l", div("sum(lead_score)", "count(lead_score)")),
    "opportunities": _of("o", "count(*)"), "customers": _CU, "session_to_lead_rate": div(_LE, _SE),
    "lead_to_mql_rate": div(_MQ, _LE), "mql_to_sql_rate": div(_SQ, _MQ), "sql_to_customer_rate": div(_CU, _SQ),
    "lead_to_customer_rate": div(_CU, _LE), "cpl": div(_SP, _LE), "cac": div(_SP, _CU), "won_revenue": _RE,
    "revenue_per_spend": div(_RE, _SP), "average_deal_value": _of("o", div("sum(won_value)", "count(*)"), "is_won = 1"),
    "average_sales_cycle": _of("o", div("sum(sales_cycle_days)", "count(sales_cycle_days)"), "is_won = 1"),
    "win_rate": div(_CU, _CL), "open_pipeline": _of("o", "sum(expected_value)", "status = 'Open'"),
    "lost_value": _of("o", "sum(expected_value)", "status = 'Lost'"), "mrr": _of("b", "sum(mrr)", "is_active = 1"),
    "mrr_end_of_period": _of("b", "sum(mrr)", "is_active = 1 AND year_month = (SELECT max(year_month) FROM fact_customer_monthly)"),
    "active_customers": _AC, "churned_customers": _CHN, "churn_rate": div(_CHN, f"{_AC} + {_CHN}"),
    **{m: FORMULAS[m] for m in WHOLE[-5:]},
}


def _pairs(source: str, scope: str, metrics: dict[str, str]) -> str:
    names = ", ".join(f"'{m}'" for m in metrics)
    values = ", ".join(dbl(v) for v in metrics.values())
    return f"SELECT {scope} AS scope, unnest([{names}]) AS metric, unnest([{values}]) AS value FROM ({source})"


def _same(names: list[str]) -> dict[str, str]:
    return {n: n for n in names}


_MONTH_SQL = by_month(["leads", "won_revenue", "mom_leads", "mom_revenue"])
_V1_CLOSED = """SELECT v1.*, closed FROM v1 LEFT JOIN (SELECT channel_id, count(*) AS closed FROM fact_opportunities
                WHERE status IN ('Won', 'Lost') GROUP BY 1) USING (channel_id)"""
RECONCILE_STEPS = {
    "r_measured": " UNION ALL ".join(
        [
            _pairs(evaluated(WHOLE, []), "'Whole period'", _same(WHOLE)),
            _pairs(evaluated(_CHANNEL, CH), "channel_name", _same(_CHANNEL)),
            _pairs(_MONTH_SQL, "year_month", _same(_MONTH)),
        ]
    ),
    "r_viewed": " UNION ALL ".join(
        [
            _pairs("SELECT 1", "'Whole period'", {m: DIRECT[m] for m in WHOLE}),
            _pairs(_V1_CLOSED, "channel_name", {**_same(_CHANNEL[:-1]), "win_rate": div("customers", "closed")}),
            _pairs("FROM v4", "year_month", _same(_MONTH)),
        ]
    ),
    "reconciled": """
        SELECT scope, metric, m.value AS measure_value, v.value AS view_value,
               CASE WHEN m.value IS NULL AND v.value IS NULL THEN 'PASS' WHEN m.value IS NULL OR v.value IS NULL THEN 'FAIL'
                    WHEN abs(m.value - v.value) <= greatest(0.01, 0.005 * abs(v.value)) THEN 'PASS' ELSE 'FAIL' END AS status
        FROM r_measured m JOIN r_viewed v USING (scope, metric)""",
}

_LAST = "(SELECT {c} FROM v4 ORDER BY year_month DESC LIMIT 1)"
_PAID = "FILTER (WHERE is_paid = 1)"
KPI_SUMMARY = f"""
    SELECT (SELECT first_day || ' to ' || last_day FROM months) AS period, {rnd(_SP, 2)} AS total_spend, {DIRECT["impressions"]}{B} AS impressions,
           {DIRECT["clicks"]}{B} AS clicks, {_SE}{B} AS sessions, {_LE} AS leads, {_MQ}{B} AS mqls, {_SQ}{B} AS sqls,
           (SELECT sum(has_opportunity) FROM v0){B} AS opportunities, (SELECT sum(is_customer) FROM v0){B} AS customers,
           {rnd("(SELECT sum(won_value) FROM v0)", 2)} AS won_revenue,
           {rnd("100.0::DOUBLE * " + DIRECT["ctr"], 2)} AS ctr_pct, {rnd(DIRECT["cpl"], 2)} AS blended_cpl,
           {rnd(div(_SP, "(SELECT sum(is_customer) FROM v0)"), 2)} AS blended_cac,
           {rnd("100.0::DOUBLE * " + div("(SELECT sum(is_customer) FROM v0)", _LE), 2)} AS lead_to_customer_pct,
           {rnd(div("(SELECT sum(won_value) FROM v0)", _SP), 2)} AS revenue_to_spend,
           {rnd(div(f"sum(spend::DECIMAL(38,2)) {_PAID}", f"sum(customers) {_PAID}"), 2)} AS paid_cac,
           {rnd("100.0::DOUBLE * " + div("sum(won_revenue::DECIMAL(38,2)) FILTER (WHERE is_paid = 0)",
                                         "sum(won_revenue::DECIMAL(38,2))"), 1)} AS non_paid_revenue_share_pct,
           {rnd(_LAST.format(c="mrr"), 2)} AS ending_mrr, {_LAST.format(c="active_customers")}{B} AS active_customers_end,
           (SELECT channel_name FROM v1 ORDER BY won_revenue DESC NULLS LAST, channel_name DESC LIMIT 1) AS top_revenue_channel,
           (SELECT channel_name FROM v1 WHERE is_paid = 1 ORDER BY cac NULLS LAST, channel_name LIMIT 1)
               AS lowest_paid_cac_channel
    FROM v1"""

CHECK_QUERIES = {
    "reconciliation": "FROM reconciled",
    "reconciliation_summary": """
        SELECT count(*) AS comparisons, count(*) FILTER (WHERE status = 'PASS') AS passed,
               count(*) FILTER (WHERE status = 'FAIL') AS failed FROM reconciled""",
    "kpi_summary": KPI_SUMMARY,
}
