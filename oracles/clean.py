"""Raw exports, cleaning and data-quality counts as SQL steps."""

from __future__ import annotations

from .compose import union
from .star import STAR, TWELFTH, VIEWS, key_of

ISO = "'%Y-%m-%d'"
NB = "chr(160)"

RAW = {
    "raw_marketing_rows": f"""
        SELECT *, {key_of('"day"')} + campaign_id * 7 AS k, {key_of('"day"')}::BIGINT AS dk,
               unnest(list_filter([0, if(({key_of('"day"')} + campaign_id * 7) % 97 = 3, 1, NULL),
                                      if(({key_of('"day"')} + campaign_id * 7) % 113 = 8, 2, NULL)],
                                  lambda x: x IS NOT NULL)) AS copy
        FROM marketing_base""",
    "raw_marketing": f"""
        SELECT CASE WHEN k % 211 = 5 THEN year("day")::VARCHAR || '-06-31' WHEN k % 211 = 9 THEN NULL
                    WHEN k % 211 = 17 THEN year("day") || '-' || month("day") || '-' || day("day")
                    ELSE strftime("day", {ISO}) END AS "date",
               CASE k % 50 WHEN 7 THEN lower(channel_name) || ' ' WHEN 11 THEN {NB} || channel_name
                           ELSE channel_name END AS channel,
               campaign_name AS campaign, impressions,
               CASE WHEN k % 89 = 6 THEN impressions + 25 ELSE clicks END AS clicks, sessions,
               (spend * CASE WHEN k % 101 = 2 THEN -1 WHEN k % 307 = 4 THEN 64 ELSE 1 END
                + (copy = 2)::INTEGER)::DECIMAL(18,2) AS spend,
               dk * 1000 + campaign_id * 10 + copy AS _pos
        FROM raw_marketing_rows JOIN dim_channel USING (channel_id) JOIN dim_campaign USING (campaign_id)""",
    "raw_leads": f"""
        SELECT CASE WHEN k % 331 <> 7 THEN k END AS lead_id,
               strftime(created, {ISO}) || ' ' || lpad((k % 24)::VARCHAR, 2, '0') || ':' || lpad((k % 60)::VARCHAR, 2, '0')
                   AS created_at,
               CASE k % 50 WHEN 7 THEN lower(channel_name) || ' ' WHEN 11 THEN '  ' || channel_name
                           ELSE channel_name END AS channel,
               coalesce(CASE WHEN k % 45 = 4 THEN replace(upper(campaign_name), ' ', {NB} || ' ') ELSE campaign_name END,
                        'Untracked push') AS campaign,
               CASE k % 40 WHEN 3 THEN lower(region_name) || ' ' WHEN 5 THEN 'Land ' || region_id ELSE region_name END AS region,
               CASE WHEN k % 30 = 4 THEN replace(replace(company_size, '-', ' - '), '+', ' +') ELSE company_size END
                   AS company_size,
               business_type,
               CASE WHEN k % 500 = 9 THEN NULL WHEN k % 500 = 11 THEN 4321 ELSE lead_score END::DOUBLE + copy AS lead_score,
               is_mql, is_sql, k * 10 + copy AS _pos
        FROM (SELECT * RENAME (lead_id AS k), unnest(if(lead_id % 61 = 2, [0, 1], [0])) AS copy FROM lead_base)
             LEFT JOIN dim_campaign USING (campaign_id) JOIN dim_region USING (region_id)""",
    "raw_opportunities": f"""
        SELECT k AS opportunity_id, if(k % 401 = 6, -k, lead_id) AS lead_id, strftime(created, {ISO}) AS created_at,
               strftime(closed, {ISO}) AS closed_at,
               CASE WHEN k % 20 = 1 THEN lower(status) WHEN k % 20 = 2 THEN upper(status)
                    WHEN k % 90 = 3 THEN status || ' ' ELSE status END AS stage,
               plan, sites, expected_value,
               CASE WHEN k % 53 = 5 THEN 0 WHEN k % 53 = 6 AND status = 'Won' THEN NULL
                    WHEN k % 59 = 7 THEN -won_value ELSE won_value END::DECIMAL(18,2) AS won_value,
               k * 10 + copy AS _pos
        FROM (SELECT * RENAME (opportunity_id AS k), unnest(if(opportunity_id % 71 = 3, [0, 1], [0])) AS copy
              FROM opportunity_base)""",
    "billed": """
        SELECT * FROM opportunity_base WHERE status = 'Won' OR (status = 'Lost' AND opportunity_id % 89 = 4)""",
    "raw_customers": f"""
        SELECT k AS customer_id, k AS opportunity_id,
               strftime(CASE WHEN closed >= created THEN closed ELSE created END, {ISO}) AS start_date, plan,
               ({TWELFTH.format(c="(CASE WHEN won_value > 0 THEN won_value ELSE expected_value END * 100)::BIGINT")}
                + copy)::DECIMAL(18,2) AS starting_mrr,
               k * 10 + copy AS _pos
        FROM (SELECT * RENAME (opportunity_id AS k), unnest(if(opportunity_id % 67 = 1, [0, 1], [0])) AS copy FROM billed)""",
    "raw_customer_monthly": """
        SELECT customer_id, year_month, (mrr + copy)::DECIMAL(18,2) AS mrr, status,
               (customer_id * 1000000 + replace(year_month, '-', '')::INTEGER) * 10 + copy AS _pos
        FROM (SELECT *, unnest(if(customer_id % 43 = 2, [0, 1], [0])) AS copy FROM billing_base
              WHERE customer_id IN (SELECT opportunity_id FROM billed))""",
}


def normal(label: str) -> str:
    return f"trim(regexp_replace(lower({label}), '[\\s\\x{{00A0}}]+', ' ', 'g'))"


def _first(table: str, keys: str) -> str:
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY _pos) = 1"


PARSED_DAY = """try_strptime("date", '%Y-%m-%d')::DATE"""

CLEAN = {
    "region_labels": f"""
        SELECT {normal("region_name")} AS label, region_id FROM dim_region
        UNION ALL SELECT 'land ' || region_id, region_id FROM dim_region""",
    "m_distinct": 'SELECT * EXCLUDE _pos, min(_pos) AS _pos, count(*) AS copies FROM raw_marketing GROUP BY ALL',
    "m_parsed": f"""
        SELECT m.* EXCLUDE spend, abs(spend) AS spend, spend < 0 AS negative, {PARSED_DAY} AS d, c.channel_id, g.campaign_id
        FROM m_distinct m LEFT JOIN dim_channel c ON {normal("channel")} = {normal("channel_name")}
             LEFT JOIN dim_campaign g ON {normal("campaign")} = {normal("campaign_name")}""",
    "m_median": """
        SELECT campaign_id, round(2 * median((spend * 100)::DOUBLE))::BIGINT AS twice
        FROM m_parsed WHERE d IS NOT NULL AND spend > 0 GROUP BY campaign_id""",
    "m_marked": """
        SELECT * REPLACE (if(outlier, ((twice // 2 + (twice % 2) * (twice // 2 % 2)) / 100.0)::DECIMAL(18,2), spend) AS spend,
                          if(impossible, sessions, clicks) AS clicks)
        FROM (SELECT *, d IS NOT NULL AND coalesce(spend * 200 > twice * 10, FALSE) AS outlier,
                     d IS NOT NULL AND clicks > impressions AS impossible
              FROM m_parsed LEFT JOIN m_median USING (campaign_id))""",
    "m_valid": f"SELECT *, {key_of('d')} AS date_key FROM m_marked WHERE d IS NOT NULL",
    "clean_marketing": f"""
        SELECT date_key, campaign_id, channel_id, impressions, clicks, sessions, spend
        FROM ({_first("m_valid", "date_key, campaign_id")})""",
    "l_first": _first("(SELECT * FROM raw_leads WHERE lead_id IS NOT NULL)", "lead_id"),
    "l_marked": f"""
        SELECT l.*, c.channel_id, g.campaign_id, r.region_id, replace(company_size, ' ', '') AS size,
               CASE WHEN lead_score BETWEEN 0 AND 100 THEN lead_score END::INTEGER AS score
        FROM l_first l LEFT JOIN dim_channel c ON {normal("channel")} = {normal("channel_name")}
             LEFT JOIN dim_campaign g ON {normal("campaign")} = {normal("campaign_name")}
             LEFT JOIN region_labels r ON {normal("region")} = r.label""",
    "clean_leads": f"""
        SELECT lead_id, {key_of("created_at::TIMESTAMP")} AS created_date_key, channel_id, campaign_id, region_id,
               size AS company_size, business_type, score AS lead_score, greatest(is_mql, is_sql) AS is_mql, is_sql
        FROM l_marked""",
    "o_distinct": "SELECT * EXCLUDE _pos, count(*) AS copies FROM raw_opportunities GROUP BY ALL",
    "o_marked": """
        SELECT o.* EXCLUDE (won_value), l.lead_id IS NULL AS orphan, l.channel_id, l.campaign_id, l.region_id, l.company_size,
               business_type, upper(trim(stage)[1]) || lower(trim(stage)[2:]) AS status,
               lower(trim(stage)) = 'won' AND coalesce(won_value, 0) <= 0 AS valueless,
               CASE WHEN lower(trim(stage)) = 'won' AND coalesce(won_value, 0) <= 0 THEN expected_value ELSE won_value END
                   AS won_value,
               created_at::DATE AS created, closed_at::DATE < created_at::DATE AS inverted,
               CASE WHEN closed_at::DATE < created_at::DATE THEN NULL ELSE closed_at::DATE END AS closed
        FROM o_distinct o LEFT JOIN clean_leads l USING (lead_id)""",
    "clean_opportunities": f"""
        SELECT opportunity_id, lead_id, {key_of("created")} AS created_date_key, {key_of("closed")} AS close_date_key,
               channel_id, campaign_id, region_id, company_size, plan, sites, status, (status = 'Won')::INTEGER AS is_won,
               expected_value, won_value, (closed - created)::INTEGER AS sales_cycle_days, valueless::INTEGER AS value_imputed
        FROM o_marked WHERE NOT orphan""",
    "c_first": _first("raw_customers", "customer_id"),
    "clean_customers": f"""
        SELECT customer_id, c.opportunity_id, o.lead_id, {key_of("start_date::DATE")} AS acquisition_date_key, o.channel_id,
               o.campaign_id, o.region_id, o.company_size, l.business_type, c.plan, starting_mrr
        FROM c_first c JOIN clean_opportunities o USING (opportunity_id) JOIN clean_leads l ON l.lead_id = o.lead_id
        WHERE is_won = 1""",
    "clean_customer_monthly": f"""
        SELECT customer_id, year_month, replace(year_month || '-01', '-', '')::INTEGER AS month_key, mrr,
               (status = 'active')::INTEGER AS is_active, (status = 'churned')::INTEGER AS is_churned
        FROM ({_first("raw_customer_monthly", "customer_id, year_month")})
        WHERE customer_id IN (SELECT customer_id FROM clean_customers)""",
}

CLEAN_STEPS = {**STAR, **RAW, **CLEAN}

# The same views and questions, asked of the cleaned tables: fact names now stand for the clean ones.
_BASES = {n: STAR[n] for n in STAR if not n.startswith("fact_") and n != "dim_customer"}
CLEAN_STAR_STEPS = {
    **_BASES,
    **RAW,
    **CLEAN,
    "fact_marketing_daily": "FROM clean_marketing",
    "fact_leads": "FROM clean_leads",
    "fact_opportunities": "FROM clean_opportunities",
    "dim_customer": "FROM clean_customers",
    "fact_customer_monthly": "FROM clean_customer_monthly",
    **VIEWS,
}


# The exports in the shape of the star, with their faults: fact names now stand for what was delivered.
DELIVERED_STEPS = {
    **_BASES,
    **RAW,
    **CLEAN,
    "fact_marketing_daily": f"""
        SELECT {key_of(PARSED_DAY)} AS date_key, g.campaign_id, c.channel_id, impressions, clicks, sessions, spend
        FROM raw_marketing LEFT JOIN dim_channel c ON {normal("channel")} = {normal("channel_name")}
             LEFT JOIN dim_campaign g ON {normal("campaign")} = {normal("campaign_name")}""",
    "fact_leads": f"""
        SELECT lead_id, {key_of("created_at::TIMESTAMP")} AS created_date_key, c.channel_id, g.campaign_id, r.region_id,
               company_size, business_type, lead_score::INTEGER AS lead_score, is_mql, is_sql
        FROM raw_leads LEFT JOIN dim_channel c ON {normal("channel")} = {normal("channel_name")}
             LEFT JOIN dim_campaign g ON {normal("campaign")} = {normal("campaign_name")}
             LEFT JOIN region_labels r ON {normal("region")} = r.label""",
    "fact_opportunities": f"""
        SELECT opportunity_id, lead_id, {key_of("created_at::DATE")} AS created_date_key,
               {key_of("closed_at::DATE")} AS close_date_key, NULL::INTEGER AS channel_id, NULL::INTEGER AS campaign_id,
               NULL::INTEGER AS region_id, NULL::VARCHAR AS company_size, plan, sites, stage AS status,
               CASE WHEN stage = 'Won' THEN 1 ELSE 0 END AS is_won, expected_value, won_value,
               (closed_at::DATE - created_at::DATE)::INTEGER AS sales_cycle_days, 0 AS value_imputed
        FROM raw_opportunities""",
    "dim_customer": f"""
        SELECT customer_id, opportunity_id, NULL::BIGINT AS lead_id, {key_of("start_date::DATE")} AS acquisition_date_key,
               NULL::INTEGER AS channel_id, NULL::INTEGER AS campaign_id, NULL::INTEGER AS region_id,
               NULL::VARCHAR AS company_size, NULL::VARCHAR AS business_type, plan, starting_mrr
        FROM raw_customers""",
    "fact_customer_monthly": """
        SELECT customer_id, year_month, replace(year_month || '-01', '-', '')::INTEGER AS month_key, mrr,
               (status = 'active')::INTEGER AS is_active, (status = 'churned')::INTEGER AS is_churned
        FROM raw_customer_monthly""",
    **VIEWS,
}


# ------------------------------------------------------------------ log of the rules
def _logged(rule: str, table: str, action: str, source: str, count: str) -> str:
    text = action.replace("'", "''")
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS \"table\", coalesce({count}, 0)::BIGINT AS rows_affected, "
        f"'{text}' AS action FROM {source}"
    )


def _hits(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


M, L, O, C = "marketing_daily", "leads", "opportunities", "customers"
CHANNELS_LISTED = "channel IN (SELECT channel_name FROM dim_channel)"
REGION_LISTED = "region IN (SELECT region_name FROM dim_region)"
WON_IDS = "(SELECT opportunity_id FROM clean_opportunities WHERE is_won = 1)"

CLEANING_LOG = union(
    [
        _logged("M1", M, "exact duplicate rows removed", "m_distinct", "sum(copies - 1)"),
        _logged("M2", M, "channel labels trimmed and matched to reference (case-insensitive)", "m_marked",
                _hits(f"NOT {CHANNELS_LISTED}")),
        _logged("M3", M, "invalid or empty dates dropped (row cannot be attributed to a day)", "m_marked", _hits("d IS NULL")),
        _logged("M4", M, "negative spend treated as sign error (abs value)", "m_valid", _hits("negative")),
        _logged("M5", M, "spend > 10x campaign median replaced by campaign median", "m_valid", _hits("outlier")),
        _logged("M6", M, "clicks > impressions: clicks reset to analytics sessions", "m_valid", _hits("impossible")),
        _logged("M7", M, "remaining duplicates on (date, campaign) removed", "m_valid",
                "count(*) - count(DISTINCT (date_key, campaign_id))"),
        _logged("L1", L, "rows without lead_id dropped (cannot be linked)", "raw_leads", _hits("lead_id IS NULL")),
        _logged("L2", L, "duplicate lead_id removed (first occurrence kept)", "raw_leads",
                "count(lead_id) - count(DISTINCT lead_id)"),
        _logged("L3", L, "unknown campaign -> campaign_id NULL, lead kept under its channel", "l_marked",
                _hits("campaign_id IS NULL")),
        _logged("L4", L, "region labels (FR/NL/casing) mapped to reference region", "l_marked", _hits(f"NOT {REGION_LISTED}")),
        _logged("L5", L, "company_size format normalised (e.g. '10 - 49' -> '10-49')", "l_marked",
                _hits("size <> company_size")),
        _logged("L6", L, "lead_score outside 0-100 set to NULL (unknown)", "l_marked",
                _hits("lead_score NOT BETWEEN 0 AND 100")),
        _logged("L6b", L, "lead_score NULL kept as unknown (excluded from averages, not imputed)", "l_marked",
                _hits("score IS NULL")),
        _logged("L7", L, "SQL without MQL: is_mql set to 1 (an SQL has passed the MQL stage)", "l_marked",
                _hits("is_sql = 1 AND is_mql = 0")),
        _logged("O1", O, "exact duplicate rows removed", "o_distinct", "sum(copies - 1)"),
        _logged("O2", O, "orphan opportunities (lead not in CRM) removed", "o_marked", _hits("orphan")),
        _logged("O3", O, "stage casing standardised to Won / Lost / Open", "o_marked", _hits("NOT orphan AND status <> stage")),
        _logged("O4", O, "Won without value: won_value = expected_value, flagged", "o_marked",
                _hits("NOT orphan AND valueless")),
        _logged("O5", O, "close date before creation: close date set NULL (cycle unknown)", "o_marked",
                _hits("NOT orphan AND inverted")),
        _logged("C1", C, "duplicate customer_id removed", "raw_customers", "count(*) - count(DISTINCT customer_id)"),
        _logged("C2", C, "customers without a Won opportunity removed", "c_first", _hits(f"opportunity_id NOT IN {WON_IDS}")),
    ]
)


# ------------------------------------------------------------------ quality checks
def _scalar(table: str, count: str) -> str:
    return f"(SELECT {count} FROM {table})"


def _where(table: str, cond: str) -> str:
    return _scalar(table, _hits(cond))


def _repeats(table: str, columns: str = "* EXCLUDE _pos") -> str:
    return f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table}))"


def _outliers(table: str, key: str) -> str:
    return f"""(SELECT count(*) FROM {table} JOIN (SELECT {key}, median((spend * 100)::DOUBLE) AS med FROM {table}
                WHERE spend > 0 GROUP BY {key}) USING ({key}) WHERE spend * 100 > 10 * med)"""


SIZES = "company_size IN ('1-9', '10-49', '50+')"
SQL_NO_MQL = "is_sql = 1 AND is_mql = 0"
BAD_SCORE = "lead_score NOT BETWEEN 0 AND 100"
RAW_WON = "lower(stage) = 'won'"

DQ = [
    ("DQ01", M, "Exact duplicate rows", "B", _repeats("raw_marketing"), _repeats("clean_marketing", "*")),
    ("DQ02", M, "Channel label not in reference (exact match)", "B",
     _where("raw_marketing", f"NOT {CHANNELS_LISTED}"),
     _where("clean_marketing", "channel_id NOT IN (SELECT channel_id FROM dim_channel)")),
    ("DQ03", M, "Invalid or empty date", "B", _where("raw_marketing", f"{PARSED_DAY} IS NULL"),
     _where("clean_marketing", "date_key NOT IN (SELECT date_key FROM dim_date)")),
    ("DQ04", M, "Negative spend (spend >= 0)", "B", _where("raw_marketing", "spend < 0"), _where("clean_marketing", "spend < 0")),
    ("DQ05", M, "Spend outlier (> 10x campaign median)", "B", _outliers("raw_marketing", "campaign"),
     _outliers("clean_marketing", "campaign_id")),
    ("DQ06", M, "Clicks greater than impressions", "B", _where("raw_marketing", "clicks > impressions"),
     _where("clean_marketing", "clicks > impressions")),
    ("DQ07", L, "Missing lead_id (critical ID)", "B", _where("raw_leads", "lead_id IS NULL"),
     _where("clean_leads", "lead_id IS NULL")),
    ("DQ08", L, "Duplicate lead_id", "B", _scalar("raw_leads", "count(lead_id) - count(DISTINCT lead_id)"),
     _scalar("clean_leads", "count(lead_id) - count(DISTINCT lead_id)")),
    ("DQ09", L, "Unknown campaign", "W",
     _where("raw_leads", f"{normal('campaign')} NOT IN (SELECT {normal('campaign_name')} FROM dim_campaign)"),
     _where("clean_leads", "campaign_id IS NULL")),
    ("DQ10", L, "Region label not in reference", "B", _where("raw_leads", f"NOT {REGION_LISTED}"),
     _where("clean_leads", "region_id NOT IN (SELECT region_id FROM dim_region)")),
    ("DQ11", L, "Company size not in 1-9 / 10-49 / 50+", "B", _where("raw_leads", f"NOT {SIZES}"),
     _where("clean_leads", f"NOT {SIZES}")),
    ("DQ12", L, "Lead score outside 0-100", "B", _where("raw_leads", BAD_SCORE), _where("clean_leads", BAD_SCORE)),
    ("DQ13", L, "Lead score missing", "W", _where("raw_leads", "lead_score IS NULL"), _where("clean_leads", "lead_score IS NULL")),
    ("DQ14", L, "SQL = 1 while MQL = 0", "B", _where("raw_leads", SQL_NO_MQL), _where("clean_leads", SQL_NO_MQL)),
    ("DQ15", O, "Duplicate opportunity rows", "B", _repeats("raw_opportunities"), _repeats("clean_opportunities", "*")),
    ("DQ16", O, "Orphan opportunity (lead unknown)", "B",
     _where("raw_opportunities", "lead_id NOT IN (SELECT lead_id FROM raw_leads WHERE lead_id IS NOT NULL)"),
     _where("clean_opportunities", "lead_id NOT IN (SELECT lead_id FROM clean_leads)")),
    ("DQ17", O, "Stage not in Won / Lost / Open", "B", _where("raw_opportunities", "stage NOT IN ('Won', 'Lost', 'Open')"),
     _where("clean_opportunities", "status NOT IN ('Won', 'Lost', 'Open')")),
    ("DQ18", O, "Won opportunity without value (> 0)", "B",
     _where("raw_opportunities", f"{RAW_WON} AND coalesce(won_value, 0) <= 0"),
     _where("clean_opportunities", "status = 'Won' AND won_value <= 0")),
    ("DQ19", O, "Negative won value", "B", _where("raw_opportunities", "won_value < 0"),
     _where("clean_opportunities", "won_value < 0")),
    ("DQ20", O, "Close date before creation date", "B", _where("raw_opportunities", "closed_at < created_at"),
     _where("clean_opportunities", "close_date_key < created_date_key")),
    ("DQ21", C, "Duplicate customer_id", "B", _scalar("raw_customers", "count(*) - count(DISTINCT customer_id)"),
     _scalar("clean_customers", "count(*) - count(DISTINCT customer_id)")),
    ("DQ22", C, "Customer without a Won opportunity", "B",
     _where("raw_customers", f"opportunity_id NOT IN (SELECT opportunity_id FROM raw_opportunities WHERE {RAW_WON})"),
     _where("clean_customers", f"opportunity_id NOT IN {WON_IDS}")),
]

TABLE_PAIRS = {
    "Marketing daily": ("raw_marketing", "clean_marketing"),
    "Leads": ("raw_leads", "clean_leads"),
    "Opportunities": ("raw_opportunities", "clean_opportunities"),
    "Customers": ("raw_customers", "clean_customers"),
    "Customer-months": ("raw_customer_monthly", "clean_customer_monthly"),
}

REPORT_STEPS = {
    "dq_results": f"""
        SELECT *, CASE WHEN clean = 0 THEN 'PASS' WHEN severity = 'WARNING' THEN 'WARN' ELSE 'FAIL' END AS status
        FROM ({union([f'''SELECT '{i}' AS check_id, '{t}' AS "table", '{d}' AS description,
                          '{"BLOCKING" if s == "B" else "WARNING"}' AS severity,
                          ({raw})::BIGINT AS raw, ({clean})::BIGINT AS clean''' for i, t, d, s, raw, clean in DQ])})""",
    "dq_rows": f"""
        SELECT *, raw_rows - clean_rows AS removed
        FROM ({union([f'''SELECT '{n}' AS "table", (SELECT count(*) FROM {r}) AS raw_rows,
                          (SELECT count(*) FROM {c}) AS clean_rows''' for n, (r, c) in TABLE_PAIRS.items()])})""",
    "dq_log": CLEANING_LOG,
}

DQ_TOTALS = """
    SELECT sum(raw)::BIGINT AS issues_raw, count(*) FILTER (WHERE raw > 0) AS checks_hit,
           coalesce(sum(clean) FILTER (WHERE severity = 'BLOCKING'), 0)::BIGINT AS blocking_left,
           coalesce(sum(clean) FILTER (WHERE severity = 'WARNING'), 0)::BIGINT AS warnings,
           if(coalesce(sum(clean) FILTER (WHERE severity = 'BLOCKING'), 0) = 0, 'PASS', 'FAIL') AS gate
    FROM dq_results"""


# ------------------------------------------------------------------ constraints
# The declared rules of the nine tables. Per table: required columns, primary key, unique columns, checks
# (name: test) and foreign keys (column: table.key).
_RULES = {
    "dim_date": (
        "date_key date year quarter month month_name year_month week day_of_week is_weekend", "date_key", "date",
        {"month_1_12": "month BETWEEN 1 AND 12", "is_weekend_flag": "is_weekend IN (0, 1)"}, {},
    ),
    "dim_channel": (
        "channel_id channel_name channel_group is_paid", "channel_id", "channel_name", {"is_paid_flag": "is_paid IN (0, 1)"}, {},
    ),
    "dim_campaign": (
        "campaign_id campaign_name channel_id objective start_date", "campaign_id", "campaign_name", {},
        {"channel_id": "dim_channel.channel_id"},
    ),
    "dim_region": ("region_id region_name region_group", "region_id", "region_name", {}, {}),
    "dim_customer": (
        "customer_id opportunity_id lead_id acquisition_date_key channel_id region_id company_size business_type plan starting_mrr",
        "customer_id", "opportunity_id",
        {
            "company_size_member": "company_size IN ('1-9', '10-49', '50+')", "plan_member": "plan IN ('Starter', 'Pro', 'Group')",
            "starting_mrr_positive": "starting_mrr > 0",
        },
        {
            "opportunity_id": "fact_opportunities.opportunity_id", "lead_id": "fact_leads.lead_id",
            "acquisition_date_key": "dim_date.date_key", "channel_id": "dim_channel.channel_id",
            "campaign_id": "dim_campaign.campaign_id", "region_id": "dim_region.region_id",
        },
    ),
    "fact_marketing_daily": (
        "date_key campaign_id channel_id impressions clicks sessions spend", "date_key campaign_id", "",
        {
            "impressions_not_negative": "impressions >= 0", "clicks_not_negative": "clicks >= 0",
            "sessions_not_negative": "sessions >= 0", "spend_not_negative": "spend >= 0",
            "clicks_within_impressions": "clicks <= impressions",
        },
        {"date_key": "dim_date.date_key", "campaign_id": "dim_campaign.campaign_id", "channel_id": "dim_channel.channel_id"},
    ),
    "fact_leads": (
        "lead_id created_date_key channel_id region_id company_size business_type is_mql is_sql", "lead_id", "",
        {
            "company_size_member": "company_size IN ('1-9', '10-49', '50+')", "lead_score_0_100": "lead_score BETWEEN 0 AND 100",
            "is_mql_flag": "is_mql IN (0, 1)", "is_sql_flag": "is_sql IN (0, 1)", "sql_implies_mql": "is_sql <= is_mql",
        },
        {
            "created_date_key": "dim_date.date_key", "channel_id": "dim_channel.channel_id",
            "campaign_id": "dim_campaign.campaign_id", "region_id": "dim_region.region_id",
        },
    ),
    "fact_opportunities": (
        "opportunity_id lead_id created_date_key channel_id region_id company_size plan sites status is_won expected_value "
        "won_value value_imputed",
        "opportunity_id", "",
        {
            "plan_member": "plan IN ('Starter', 'Pro', 'Group')", "sites_at_least_one": "sites >= 1",
            "status_member": "status IN ('Won', 'Lost', 'Open')", "is_won_flag": "is_won IN (0, 1)",
            "expected_value_positive": "expected_value > 0", "won_value_not_negative": "won_value >= 0",
            "sales_cycle_not_negative": "sales_cycle_days >= 0", "value_imputed_flag": "value_imputed IN (0, 1)",
            "won_deal_has_value": "status <> 'Won' OR won_value > 0",
        },
        {
            "lead_id": "fact_leads.lead_id", "created_date_key": "dim_date.date_key", "close_date_key": "dim_date.date_key",
            "channel_id": "dim_channel.channel_id", "campaign_id": "dim_campaign.campaign_id", "region_id": "dim_region.region_id",
        },
    ),
    "fact_customer_monthly": (
        "customer_id year_month month_key mrr is_active is_churned", "customer_id year_month", "",
        {"mrr_not_negative": "mrr >= 0", "is_active_flag": "is_active IN (0, 1)", "is_churned_flag": "is_churned IN (0, 1)"},
        {"customer_id": "dim_customer.customer_id", "month_key": "dim_date.date_key"},
    ),
}


def _declared() -> list[tuple[str, str, str, str]]:
    """(table, constraint, kind, count of failures) for every declared rule."""
    rows = []
    for t, (required, key, unique, checks, foreign) in _RULES.items():
        rows += [(t, f"{c} not null", "NOT NULL", _where(t, f'"{c}" IS NULL')) for c in required.split()]
        rows += [(t, n, "CHECK", _where(t, f"NOT ({test})")) for n, test in checks.items()]
        for keys, kind in [(key.split(), "PRIMARY KEY"), *[([u], "UNIQUE") for u in unique.split()]]:
            quoted = ", ".join(f'"{k}"' for k in keys)
            rows.append((t, ", ".join(keys), kind, _repeats(t, quoted)))
        for c, target in foreign.items():
            parent, column = target.split(".")
            orphan = f"{c} IS NOT NULL AND {c} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)"
            rows.append((t, f"{c} -> {parent}", "FOREIGN KEY", _where(t, orphan)))
    return rows


CONSTRAINT_ROWS = union(
    [
        f"""SELECT '{t}' AS "table", '{n}' AS "constraint", '{k}' AS kind, ({f})::BIGINT AS failures"""
        for t, n, k, f in _declared()
    ]
)


# ------------------------------------------------------------------ integrity tests
def _test(name: str, failures: str) -> str:
    return f"SELECT '{name}' AS test_name, ({failures})::BIGINT AS failures"


def _sum(table: str, column: str, where: str = "TRUE") -> str:
    return f"(SELECT sum({column}) FROM {table} WHERE {where})"


WON = "is_won = 1"
INTEGRITY = union(
    [
        _test("sql_implies_mql", _where("fact_leads", SQL_NO_MQL)),
        _test("spend_not_negative", _where("fact_marketing_daily", "spend < 0")),
        _test("lead_score_in_range", _where("fact_leads", BAD_SCORE)),
        _test("won_value_not_negative", _where("fact_opportunities", "won_value < 0")),
        _test("won_deal_has_value", _where("fact_opportunities", "status = 'Won' AND won_value <= 0")),
        _test("no_missing_critical_ids",
              _where("fact_leads", "lead_id IS NULL") + " + "
              + _where("fact_opportunities", "opportunity_id IS NULL OR lead_id IS NULL") + " + "
              + _where("dim_customer", "customer_id IS NULL OR opportunity_id IS NULL")),
        _test("opportunity_has_lead", "SELECT count(*) FROM fact_opportunities ANTI JOIN fact_leads USING (lead_id)"),
        _test("customer_has_won_opportunity",
              f"SELECT count(*) FROM dim_customer ANTI JOIN (FROM fact_opportunities WHERE {WON}) USING (opportunity_id)"),
        _test("customers_equal_won_opportunities",
              f"abs((SELECT count(*) FROM dim_customer) - {_where('fact_opportunities', WON)})"),
        _test("funnel_is_monotonic", _where("v1", "leads < mqls OR mqls < sqls OR opportunities < customers")),
        _test("view_totals_match_facts",
              f"abs({_sum('v1', 'leads')} - (SELECT count(*) FROM fact_leads)) + "
              f"round(abs({_sum('v1', 'spend::DECIMAL(38,2)')} - {_sum('fact_marketing_daily', 'spend')}))"),
        _test("revenue_reconciles",
              f"round(abs({_sum('v4', 'won_revenue::DECIMAL(38,2)')} - {_sum('fact_opportunities', 'won_value', WON)}))"),
        _test("no_cac_for_unpaid_channels", _where("v1", "is_paid = 0 AND spend = 0 AND cac IS NOT NULL")),
        _test("close_after_create", _where("fact_opportunities", "close_date_key < created_date_key")),
    ]
)


def plain(columns: dict[str, str], table: str) -> str:
    """Money as double and days as ISO text."""
    parts = []
    for c, kind in columns.items():
        cast = "DOUBLE" if kind.startswith("decimal") else "VARCHAR" if kind == "date" else None
        parts.append(f'"{c}"::{cast} AS "{c}"' if cast else f'"{c}"')
    return f"SELECT {', '.join(parts)} FROM {table}"


