"""Views, analyses and measures on a small star made of edge cases."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from funnelworks.operators.constraints import check_constraints
from funnelworks.plans.analyses import ANALYSES
from funnelworks.plans.integrity import integrity_tests
from funnelworks.plans.measures import check_names, column_label, Evaluator, MEASURES, parts_of, reach, UnreachableError
from funnelworks.plans.model import report_model
from funnelworks.plans.reconcile import reconciliation
from funnelworks.plans.reports import DATASETS, Reports
from funnelworks.plans.views import Views

CHANNELS = [(1, "Search", "Paid Search", 1), (2, "Social", "Paid Social", 1), (3, "Mail", "Owned", 0), (4, "Idle", "Owned", 0)]
CAMPAIGNS = [(10, "A", 1, "o", None), (11, "B", 1, "o", None), (20, "C", 2, "o", None), (30, "D", 3, "o", None)]
REGIONS = [(1, "North", "N"), (2, "South", "S")]


def lead(i, day, channel, campaign, score=50, mql=1, sql=1, size="1-9"):
    return (i, day, channel, campaign, 1 if i % 2 else 2, size, "Cafe", score, mql, sql)


def deal(i, lead_id, created, closed, channel, campaign, status, expected, won, days):
    region = 1 if lead_id % 2 else 2
    is_won = int(status == "Won")
    return (i, lead_id, created, closed, channel, campaign, region, "1-9", "Pro", 1, status, is_won, expected, won, days, 0)


@pytest.fixture(scope="module")
def star(make_star):
    return make_star(
        dim_channel=CHANNELS,
        dim_campaign=CAMPAIGNS,
        dim_region=REGIONS,
        fact_marketing_daily=[
            (20251101, 10, 1, 1000, 100, 80, 100.0),
            (20251201, 11, 1, 500, 0, 20, 50.0),
            (20260105, 20, 2, 0, 0, 0, 0.0),  # a paid channel that spent nothing
            (20260105, 30, 3, 10, 5, 5, 0.0),
        ],
        fact_leads=[
            lead(1, 20251105, 1, 10),
            lead(2, 20251106, 1, 10, score=None),
            lead(3, 20251210, 1, 11, score=90),
            lead(4, 20260110, 2, 20, mql=1, sql=0),
            lead(5, 20260111, 3, None),
            lead(6, 20260312, 3, 30, mql=0, sql=0, score=10),  # nothing in February: a missing month
        ],
        fact_opportunities=[
            deal(1, 1, 20251107, 20251120, 1, 10, "Won", 200.0, 150.0, 13),
            deal(2, 1, 20251108, 20251130, 1, 10, "Won", 300.0, 300.0, 22),  # second deal of one lead
            deal(3, 3, 20251211, 20260105, 1, 11, "Lost", 500.0, 0.0, 25),
            deal(4, 5, 20260112, None, 3, None, "Won", 80.0, 80.0, None),  # won without a close date
            deal(5, 4, 20260113, None, 2, 20, "Open", 70.0, 0.0, None),
        ],
        dim_customer=[
            (1, 1, 1, 20251120, 1, 10, 1, "1-9", "Cafe", "Pro", 12.5),
            (2, 2, 1, 20251130, 1, 10, 1, "1-9", "Cafe", "Pro", 25.0),
            (4, 4, 5, 20260112, 3, None, 1, "1-9", "Bar", "Group", 7.0),
        ],
        fact_customer_monthly=[
            (1, "2025-11", 20251101, 12.5, 1, 0),
            (1, "2025-12", 20251201, 0.0, 0, 1),
            (2, "2025-11", 20251101, 25.0, 1, 0),
            (2, "2025-12", 20251201, 26.0, 1, 0),
            (4, "2026-01", 20260101, 7.0, 1, 0),
        ],
    )


@pytest.fixture(scope="module")
def views(star):
    return Views(star)


@pytest.fixture(scope="module")
def model(spark, star):
    checks = spark.createDataFrame(
        [("DQ01", "t", "a", "BLOCKING", 5, 0, "PASS"), ("DQ09", "t", "b", "WARNING", 3, 2, "WARN")],
        "check_id string, table string, description string, severity string, raw bigint, clean bigint, status string",
    )
    counts = spark.createDataFrame([("Leads", 9, 6, 3)], "table string, raw_rows bigint, clean_rows bigint, removed bigint")
    log = spark.createDataFrame([("L1", "leads", 3, "x")], "rule string, table string, rows_affected bigint, action string")
    return report_model(star, checks, counts, log)


def test_lead_outcomes(views):
    by_id = {r["lead_id"]: r for r in rows(views.lead_outcomes)}
    one = by_id[1]
    assert (one["has_opportunity"], one["is_customer"], float(one["won_value"]), one["won_cycle_days"]) == (1, 1, 450.0, 17.5)
    two = by_id[2]
    assert (two["has_opportunity"], two["is_customer"], float(two["won_value"]), two["won_cycle_days"]) == (0, 0, 0.0, None)
    assert by_id[5]["is_customer"] == 1 and by_id[5]["won_cycle_days"] is None


def test_channel_performance(views):
    by_name = {r["channel_name"]: r for r in rows(views.channel_performance)}
    search, social, idle = by_name["Search"], by_name["Social"], by_name["Idle"]
    assert (search["leads"], search["opportunities"], search["customers"]) == (3, 2, 1)  # leads that have one
    assert (search["cac"], search["cpl"], search["cpc"], search["avg_lead_score"]) == (150.0, 50.0, 1.5, 70.0)
    assert (social["spend"], social["cpl"], social["cac"], social["revenue_to_spend"]) == (0.0, None, None, None)
    assert social["ctr"] is None and social["cpc"] is None
    assert (idle["leads"], idle["sessions"], idle["revenue_share"]) == (None, None, None)  # unknown, not zero
    assert search["revenue_share"] == round(450 / 530, 4)


def test_campaign_performance(views):
    by_name = {r["campaign_name"]: r for r in rows(views.campaign_performance)}
    assert by_name["A"]["recommendation"] == "SCALE" and by_name["B"]["recommendation"] == "REDUCE"
    assert by_name["C"]["recommendation"] == "REDUCE"  # no spend, no ratio
    assert by_name["D"]["recommendation"] == "NON-PAID"
    assert (by_name["D"]["leads"], by_name["D"]["won_revenue"]) == (1, 0.0)  # the lead without campaign is not here
    assert [by_name[c]["revenue_rank"] for c in "ABCD"] == [1, 2, 2, 2]  # ties share a rank


def test_funnel(views):
    search = [r for r in rows(views.funnel, "channel_name", "stage_order") if r["channel_name"] == "Search"]
    assert [r["volume"] for r in search] == [100, 3, 3, 3, 2, 1]
    assert search[0]["previous_volume"] is None
    assert search[1]["conversion_from_previous"] == 0.03 and search[1]["drop_off"] == 0.97


def test_monthly_management(views):
    by_month = {r["year_month"]: r for r in rows(views.monthly_management)}
    assert list(sorted(by_month)) == ["2025-11", "2025-12", "2026-01", "2026-02", "2026-03"]
    feb = by_month["2026-02"]
    assert (feb["leads"], feb["spend"], feb["cpl"], feb["mom_leads"]) == (0, 0.0, None, -1.0)
    assert by_month["2026-01"]["won_revenue"] == 80.0  # no close date: counted when created
    assert by_month["2026-01"]["cpl"] == 0.0 and by_month["2026-03"]["mom_leads"] is None
    assert (by_month["2025-12"]["active_customers"], by_month["2025-12"]["churn_rate"]) == (1, 0.5)


def test_opportunity_and_customer_views(views):
    deals = {r["opportunity_id"]: r for r in rows(views.opportunity_detail)}
    assert (deals[4]["campaign_name"], deals[4]["close_month"]) == ("Unassigned", None)
    assert (deals[5]["open_pipeline_value"], deals[3]["lost_value"], deals[1]["lost_value"]) == (70.0, 500.0, 0.0)
    customers = {r["customer_id"]: r for r in rows(views.customer_value)}
    assert (customers[1]["months_billed"], customers[1]["has_churned"], customers[1]["last_month"]) == (2, 1, "2025-12")


def test_analyses(views):
    assert len(ANALYSES) == 38
    run = lambda i: rows(ANALYSES[i][2](views))
    assert [r["channel_name"] for r in run("q04")][-1] in ("Idle", "Mail", "Social")  # blanks last
    assert {r["score_band"]: r["leads"] for r in run("q14b")} == {"Unknown": 1, "0-39": 1, "40-59": 3, "80-100": 1}
    trend = run("q15")
    assert [(r["year_month"], r["previous_month"]) for r in trend][-1] == ("2026-03", 2)  # previous row, not month
    pareto = run("q09_11")
    assert pareto[0]["channel_name"] == "Search" and pareto[-1]["channel_name"] == "Idle"
    weakest = {(r["channel_name"], r["weakest_transition_into"]) for r in run("q01b")}
    assert {s for c, s in weakest if c == "Search"} == {"Customer"}
    assert {s for c, s in weakest if c == "Idle"} == {"MQL", "SQL", "Opportunity", "Customer"}  # all unknown: a tie
    assert {(r["campaign_name"], r["open_pipeline_value"]) for r in run("q13c")} == {("C", 70.0)}
    assert {r["recommendation"]: r["campaign_list"] for r in run("q18b")} == {"SCALE": "A", "REDUCE": "B, C"}


def test_integrity_and_constraints(spark, views, star, make_star):
    assert {r["test_name"] for r in rows(integrity_tests(views)) if r["failures"]} == set()
    assert {(r["table"], r["constraint"]) for r in rows(check_constraints(star)) if r["failures"]} == {
        ("dim_campaign", "start_date not null")
    }
    broken = make_star(
        dim_channel=[(1, "S", "g", 1), (1, "S", "g", 7)],
        fact_leads=[(1, 20251105, 9, None, None, "2-3", "Cafe", 101, 0, 1), (1, 20991231, 1, None, 1, "1-9", "Cafe", None, 1, 1)],
    )
    found = {(r["table"], r["constraint"]): r["failures"] for r in rows(check_constraints(broken)) if r["failures"]}
    assert found == {
        ("dim_channel", "channel_id"): 1,
        ("dim_channel", "channel_name"): 1,
        ("dim_channel", "is_paid_flag"): 1,
        ("fact_leads", "lead_id"): 1,
        ("fact_leads", "region_id not null"): 1,
        ("fact_leads", "company_size_member"): 1,
        ("fact_leads", "lead_score_0_100"): 1,
        ("fact_leads", "sql_implies_mql"): 1,
        ("fact_leads", "channel_id -> dim_channel"): 1,
        ("fact_leads", "created_date_key -> dim_date"): 1,
        ("fact_leads", "region_id -> dim_region"): 1,
    }


def test_integrity_tests_find_failures(make_star):
    bad = Views(
        make_star(
            dim_channel=CHANNELS,
            dim_campaign=CAMPAIGNS,
            dim_region=REGIONS,
            fact_marketing_daily=[(20251101, 10, 1, 10, 10, 1, -5.0)],
            fact_leads=[lead(1, 20251105, 1, 10, mql=0, sql=1), lead(2, 20300101, 1, 10, score=101)],
            fact_opportunities=[
                deal(1, 77, 20251107, 20251101, 1, 10, "Won", 10.0, -1.0, None),
                deal(2, 1, 20300107, None, 1, 10, "Won", 10.0, 20.0, None),
            ],
            dim_customer=[(1, 5, 1, 20251120, 1, 10, 1, "1-9", "Cafe", "Pro", 12.5)],
        )
    )
    found = {r["test_name"]: r["failures"] for r in rows(integrity_tests(bad))}
    assert len(found) == 14
    assert {k for k, n in found.items() if n} == {
        "sql_implies_mql", "spend_not_negative", "lead_score_in_range", "won_value_not_negative", "won_deal_has_value",
        "opportunity_has_lead", "customer_has_won_opportunity", "customers_equal_won_opportunities",
        "funnel_is_monotonic", "view_totals_match_facts", "revenue_reconciles", "close_after_create",
    }


def test_measures(model):
    assert len(MEASURES) == 47
    e = Evaluator(model)
    one = e.evaluate(["leads", "customers", "won_revenue", "cac", "mrr", "mrr_end_of_period", "arr_run_rate"]).first()
    assert (one["leads"], one["customers"], one["won_revenue"], one["cac"]) == (6, 3, 530.0, 50.0)  # won deals
    assert (one["mrr"], one["mrr_end_of_period"], one["arr_run_rate"]) == (70.5, 7.0, 84.0)
    by_channel = {
        r["channel_name"]: r
        for r in rows(e.evaluate(["cac", "leads", "share_of_leads", "mrr_end_of_period"], ["DimChannel.channel_name"]))
    }
    assert "Idle" not in by_channel  # no measure has a value there
    assert by_channel["Social"]["cac"] is None and by_channel["Search"]["share_of_leads"] == 0.5
    assert by_channel["Search"]["mrr_end_of_period"] == 26.0  # last month of the group, not of all


def test_names_of_measures_and_columns(model):
    columns = {name: model[name].columns for name in ("FactMarketingDaily", "FactLeads", "FactCustomerMonthly")}
    check_names(columns)
    assert column_label("FactMarketingDaily", "clicks") == "clicks_value" and column_label("FactLeads", "lead_id") == "lead_id"
    with pytest.raises(ValueError, match="columns of FactMarketingDaily"):
        check_names({"FactMarketingDaily": ["clicks", "clicks_value"]})


def test_measures_that_replace_a_filter_alone(model):
    e = Evaluator(model)
    paid = {r["is_paid"]: r["paid_spend"] for r in rows(e.evaluate(["paid_spend"], ["DimChannel.is_paid"]))}
    total = e.evaluate(["paid_spend"]).first()["paid_spend"]
    assert set(paid) == {0, 1} and set(paid.values()) == {total}


def test_columns_of_one_name_and_blank_rows(model):
    e = Evaluator(model)
    df = e.evaluate(["leads"], ["DimCampaign.channel_id", "DimChannel.channel_id"])
    assert df.columns == ["DimCampaign_channel_id", "DimChannel_channel_id", "leads"]
    assert sum(r["leads"] for r in df.collect()) == 6
    revenue = e.evaluate(["won_revenue"], ["DimChannel.channel_name", "DimDate.year_month"])
    assert revenue.where("won_revenue IS NULL").count() == 0 and revenue.count() > 0


def test_months_are_compared_by_calendar(model):
    e = Evaluator(model)
    by_month = {r["year_month"]: r for r in rows(e.evaluate(["leads", "mom_leads"], ["DimDate.year_month"]))}
    assert (by_month["2026-01"]["mom_leads"], by_month["2026-02"]["leads"], by_month["2026-02"]["mom_leads"]) == (1.0, None, -1.0)
    assert by_month["2026-03"]["mom_leads"] is None  # February is empty
    only = e.evaluate(["mom_leads"], ["DimDate.year_month"], {"DimDate.year_month": lambda c: c == "2026-01"})
    assert [tuple(r) for r in only.collect()] == [("2026-01", 1.0)]  # the filter does not hide the month before
    with pytest.raises(ValueError):
        e.evaluate(["mom_leads"], ["DimChannel.channel_name"])


def test_filters_follow_relationships(model):
    e = Evaluator(model)
    with pytest.raises(UnreachableError):
        e.evaluate(["total_spend"], ["DimRegion.region_name"])
    with pytest.raises(UnreachableError):
        e.evaluate(["lead_to_customer_rate"], ["FactLeads.score_band"])
    with pytest.raises(ValueError):
        e.evaluate(["leads"], ["DimDate.nonsense"])
    with pytest.raises(ValueError):
        e.evaluate(["nonsense"])
    assert set(reach("FactCustomerMonthly")) == {
        "FactCustomerMonthly", "DimDate", "DimCustomer", "DimChannel", "DimCampaign", "DimRegion",
    }
    paid = e.evaluate(
        ["paid_spend", "share_of_leads", "campaigns_to_scale"], (), {"DimChannel.is_paid": lambda c: c == 0}
    ).first()
    assert paid["paid_spend"] == 150.0  # the measure's own filter on the column wins
    assert paid["share_of_leads"] == pytest.approx(2 / 6) and paid["campaigns_to_scale"] == 1
    assert parts_of("cac") == ["spend", "customers"]


def test_report_model(model):
    campaigns = {r["campaign_id"]: r for r in rows(model["DimCampaign"])}
    assert (campaigns[0]["campaign_name"], campaigns[0]["recommendation"]) == ("Unassigned", "UNASSIGNED")
    assert [campaigns[i]["recommendation"] for i in (10, 11, 20, 30)] == ["SCALE", "REDUCE", "REDUCE", "NON-PAID"]
    assert model["FactLeads"].where("campaign_id IS NULL").count() == 0
    assert {r["revenue_date_key"] for r in rows(model["FactOpportunities"].where("opportunity_id = 4"))} == {20260112}


def test_reports(model, views):
    reports = Reports(model, views)
    assert reports.dataset("rd12").first()["channel_name"] == "Search"
    assert {r["score_band"]: r["lead_to_customer_rate"] for r in rows(reports.conversion_by_band())}["80-100"] == 0.0
    filtered = reports.dataset("rd01", {"DimChannel.channel_name": lambda c: c == "Mail"}).first()
    assert (filtered["leads"], filtered["won_revenue"]) == (2, 80.0)
    assert len(DATASETS) == 24 and reports.funnel().count() == 5


def test_reconciliation(model, views):
    result = reconciliation(model, views)
    by_scope = {(r["scope"], r["metric"]): r["status"] for r in rows(result)}
    whole = [k for k in by_scope if k[0] == "Whole period"]
    assert len(whole) == 36 and all(by_scope[k] == "PASS" for k in whole)
    # a lead with two won deals is one customer for the view and two for the measure
    assert by_scope["Search", "customers"] == "FAIL" and by_scope["Search", "won_revenue"] == "PASS"
    assert result.where(F.col("scope") == "Idle").count() == 0
