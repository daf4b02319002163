"""All expected results by query name."""

from __future__ import annotations

from .analyses import ANALYSIS_QUERIES
from funnelworks.plans.analyses import ANALYSES
from funnelworks.registry import BY_REGION, FACT_MEASURES, MONTHLY_CHANGE, TOTAL_MEASURES
from funnelworks.schemas import EXPORT_SCHEMAS, REFERENCE_SCHEMAS, STAR_SCHEMAS

from .clean import (
    CLEAN_STAR_STEPS,
    CLEAN_STEPS,
    DELIVERED_STEPS,
    CONSTRAINT_ROWS,
    DQ_TOTALS,
    INTEGRITY,
    REPORT_STEPS,
    plain,
)
from .compose import compose, union
from .measures import CHECK_QUERIES, FILTERED, RECONCILE_STEPS, REPORT_QUERIES, by_month, evaluated
from .measures import STEPS as REPORT_MODEL_STEPS

VIEW_QUERIES = {
    "v0_lead_outcomes": "SELECT * REPLACE (won_value::DOUBLE AS won_value) FROM v0",
    "v1_channel_performance": "SELECT * FROM v1",
    "v2_campaign_performance": "SELECT * FROM v2",
    "v3_funnel": "SELECT * FROM v3",
    "v4_monthly_management": "SELECT * FROM v4",
    "v5_opportunity_detail": "SELECT * FROM v5",
    "v6_customer_value": "SELECT * FROM v6",
}

EXPECTED: dict[str, str] = {}
for _queries in (VIEW_QUERIES, ANALYSIS_QUERIES):
    EXPECTED.update({name: compose(CLEAN_STAR_STEPS, sql) for name, sql in _queries.items()})

_CLEAN_TABLES = {
    "clean_marketing": "fact_marketing_daily",
    "clean_leads": "fact_leads",
    "clean_opportunities": "fact_opportunities",
    "clean_customers": "dim_customer",
    "clean_customer_monthly": "fact_customer_monthly",
}
CLEANING_QUERIES = {
    **{f"raw_{n}": plain({**c, "_pos": "bigint"}, f"raw_{n}") for n, c in EXPORT_SCHEMAS.items()},
    **{n: plain(STAR_SCHEMAS[t], n) for n, t in _CLEAN_TABLES.items()},
    "clean_dim_date": plain(STAR_SCHEMAS["dim_date"], "dim_date"),
    "cleaning_log": "FROM dq_log",
    "dq_checks": "FROM dq_results",
    "dq_row_counts": "FROM dq_rows",
    "dq_totals": DQ_TOTALS,
}
EXPECTED.update({n: compose({**CLEAN_STEPS, **REPORT_STEPS}, sql) for n, sql in CLEANING_QUERIES.items()})
EXPECTED.update(
    {n: compose(CLEAN_STAR_STEPS, sql) for n, sql in {"constraints": CONSTRAINT_ROWS, "integrity_tests": INTEGRITY}.items()}
)

MEASURE_QUERIES = {
    "measures_total": evaluated(TOTAL_MEASURES, []),
    "measures_by_channel": evaluated(FACT_MEASURES, ["channel_name"]),
    "measures_by_campaign": evaluated(FACT_MEASURES, ["campaign_name"]),
    "measures_by_region": evaluated(BY_REGION, ["region_name"]),
    "measures_by_month": by_month([*FACT_MEASURES, *MONTHLY_CHANGE]),
    "measures_filtered": FILTERED,
}
EXPECTED.update({n: compose(REPORT_MODEL_STEPS, sql) for n, sql in {**MEASURE_QUERIES, **REPORT_QUERIES}.items()})
EXPECTED.update({n: compose({**REPORT_MODEL_STEPS, **RECONCILE_STEPS}, sql) for n, sql in CHECK_QUERIES.items()})

def _numbered():
    """The questions with their number within their suite."""
    groups: list[str] = []
    for i, (group, _, plan) in ANALYSES.items():
        groups.append(group)
        yield i, group, groups.count(group), plan


# the run log counts the rows of every question, asked of the clean tables
_RUN_LOG = union(
    [
        f"""SELECT '{group}' AS suite, {number} AS number, '{i}' AS label, n AS rows_returned, if(n > 0, 'PASS', 'EMPTY') AS status
            FROM (SELECT count(*) AS n FROM ({ANALYSIS_QUERIES[f"{i}_{plan.__name__}"]}))"""
        for i, group, number, plan in _numbered()
    ]
    + [
        f"""SELECT 'integrity' AS suite, (row_number() OVER (ORDER BY test_name))::INTEGER AS number, test_name AS label, 1::BIGINT AS rows_returned,
                   if(failures = 0, 'PASS', 'FAIL (' || failures || ')') AS status FROM ({INTEGRITY})"""
    ]
)
EXPECTED["run_log"] = compose(CLEAN_STAR_STEPS, _RUN_LOG)

SOURCE_QUERIES = {
    **{
        f"sample_{n}": plain(c, f"(SELECT * FROM raw_{n} ORDER BY _pos LIMIT 200)") for n, c in EXPORT_SCHEMAS.items()
    },
    "csv_marketing": CLEANING_QUERIES["clean_marketing"],
    "csv_leads": CLEANING_QUERIES["clean_leads"],
    "csv_opportunities": CLEANING_QUERIES["clean_opportunities"],
    "csv_customer_monthly": CLEANING_QUERIES["clean_customer_monthly"],
    "keep_first_lines": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, copies
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity, l_extendedprice,
                                   l_discount, l_returnflag, l_shipdate) = 1""",
    "collapse_exact_orders": """
        SELECT o_orderstatus, o_orderpriority, o_orderdate::DATE::VARCHAR AS "day", min(o_orderkey) AS first_order,
               count(*) AS copies FROM orders GROUP BY ALL""",
    "median_price": """
        SELECT l_returnflag, (2 * median((l_extendedprice * 100)::BIGINT::DOUBLE)) / 100 / 2 AS median_price
        FROM lineitem GROUP BY l_returnflag""",
}
EXPECTED.update({n: compose(CLEAN_STEPS, sql) for n, sql in SOURCE_QUERIES.items()})
EXPECTED["csv_customers"] = EXPECTED["clean_customers"]
EXPECTED["csv_corrupt_rows"] = compose(
    CLEAN_STEPS,
    union([f"SELECT '{n}' AS export, (SELECT count(*) FROM raw_{n}) AS rows, 0::BIGINT AS corrupt" for n in EXPORT_SCHEMAS]),
)

# what is exported and read back is what was computed
_EXPORTED = {
    "export_channel_performance": "v1_channel_performance",
    "export_campaign_performance": "v2_campaign_performance",
    "export_monthly_management": "v4_monthly_management",
    "export_funnel": "v3_funnel",
    "export_opportunity_detail": "v5_opportunity_detail",
    "export_customer_value": "v6_customer_value",
    "kpi_json": "kpi_summary",
    **{n.replace("model_", "import_", 1): n for n in EXPECTED if n.startswith("model_")},
}
EXPECTED.update({n: EXPECTED[of] for n, of in _EXPORTED.items()})

# reference data that was written as CSV and read back
EXPECTED.update(
    {
        f"csv_{n}": compose(CLEAN_STEPS, plain(REFERENCE_SCHEMAS[n], t))
        for n, t in {"channels": "dim_channel", "campaigns": "dim_campaign", "regions": "dim_region"}.items()
    }
)

# rows of everything that is published
_VIEW_STEPS = {
    "channel_performance": "v1", "campaign_performance": "v2", "funnel": "v3", "monthly_management": "v4", "opportunity_detail": "v5",
    "customer_value": "v6",
}
_PUBLISHED = [
    *[("star", t, t) for t in STAR_SCHEMAS],
    *[("view", n, step) for n, step in _VIEW_STEPS.items()],
    *[("model", n.removeprefix("model_"), f"({sql})") for n, sql in REPORT_QUERIES.items() if n.startswith("model_")],
    *[("sample", n, f"(SELECT 1 FROM raw_{n} LIMIT 200)") for n in EXPORT_SCHEMAS],
]
EXPECTED["published"] = compose(
    REPORT_MODEL_STEPS,
    union([f"SELECT '{kind}' AS kind, '{name}' AS name, count(*) AS rows FROM {of}" for kind, name, of in _PUBLISHED]),
)

_DELIVERED = {
    "delivered_constraints": CONSTRAINT_ROWS,
    "delivered_integrity_tests": INTEGRITY,
    "delivered_q25b": ANALYSIS_QUERIES["q25b_business_rules"],
    "delivered_q25c": ANALYSIS_QUERIES["q25c_orphans"],
    "delivered_q25d": ANALYSIS_QUERIES["q25d_repeated_keys"],
}
EXPECTED.update({n: compose(DELIVERED_STEPS, sql) for n, sql in _DELIVERED.items()})
