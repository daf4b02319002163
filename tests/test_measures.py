"""Contexts of measures against pandas, on the published star; and what their plans read."""

from __future__ import annotations

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from funnelworks import registry
from funnelworks.plans.views import Views

SMALL = "/root/testdata/sf0.001"
FACTS = ("fact_marketing_daily", "fact_leads", "fact_opportunities", "fact_customer_monthly")


@pytest.fixture(scope="module")
def reports(spark):
    return registry._reports(spark, SMALL)


@pytest.fixture(scope="module")
def tables(reports):
    star = reports.views.star
    return {n: star[n].toPandas() for n in (*FACTS, "dim_date", "dim_channel", "dim_customer")}


@pytest.fixture(scope="module")
def placed(tables):
    """Leads, deals and billing with month, channel and whether the channel is paid."""
    days = tables["dim_date"].set_index("date_key").year_month
    channels = tables["dim_channel"].set_index("channel_id")

    def add(df, key):
        return df.assign(
            month=df[key].map(days), channel=df.channel_id.map(channels.channel_name), paid=df.channel_id.map(channels.is_paid)
        )

    deals = tables["fact_opportunities"]
    deals = add(deals.assign(day=deals.close_date_key.fillna(deals.created_date_key).astype(int)), "day")
    billing = tables["fact_customer_monthly"].merge(tables["dim_customer"][["customer_id", "channel_id"]], on="customer_id")
    return add(tables["fact_leads"], "created_date_key"), deals, add(billing, "month_key")


def scans(df):
    """(table, partition filters) of every file scan of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"FileScan parquet.*?/(\w+)\], PartitionFilters: (\[.*?\]), PushedFilters", plan)


@pytest.mark.parametrize("name", ["measures_total", "measures_by_channel", "measures_by_month", "measures_filtered"])
def test_every_fact_is_read_once(spark, name):
    read = [table for table, _ in scans(registry.QUERIES[name](spark, SMALL)) if table in FACTS]
    assert sorted(read) == sorted(set(read)) and len(read) >= 3


def test_months_are_left_out_by_a_filter_on_the_calendar(reports):
    e = reports.evaluator
    for by, filters in (
        ((), {"DimDate.year": lambda c: c == 1998}),
        (("DimDate.year_month",), {"DimDate.year_month": lambda c: c.between("1996-02", "1996-05")}),
    ):
        measures = ["leads", "won_revenue", "total_spend", "mrr_end_of_period", *(["mom_leads", "mom_revenue"] if by else [])]
        read = {t: f for t, f in scans(e.evaluate(measures, by, filters)) if t in FACTS}
        assert set(read) == set(FACTS) and all("dynamicpruning" in f for f in read.values())


def test_months_are_left_out_in_views_and_questions(reports):
    fresh = Views(reports.views.star)  # plans over the stored facts
    month = "'1996-03'"
    pruned = lambda df: [t for t, f in scans(df) if t in FACTS and f != "[]"]
    assert pruned(fresh.lead_outcomes.where(f"year_month = {month}")) == ["fact_leads"]
    assert pruned(fresh.opportunity_detail.where(f"close_month = {month}")) == ["fact_opportunities"]
    assert sorted(pruned(fresh.monthly_management)) == sorted(FACTS)
    assert pruned(registry.ANALYSES["q25f"][2](reports.views)) == ["fact_marketing_daily"]
    published = [f for t, f in scans(reports.views.lead_outcomes.where(f"year_month = {month}")) if t == "lead_outcomes"]
    assert published and "1996-03" in published[0]


def test_pruned_views_are_the_same(reports):
    star = reports.views.star
    fresh, month = Views(star), "1996-03"
    whole = fresh.lead_outcomes.collect()
    assert len(whole) == star.fact_leads.count()
    assert sorted(map(str, fresh.lead_outcomes.where(F.col("year_month") == month).collect())) == sorted(
        str(r) for r in whole if r.year_month == month
    )
    deals = fresh.opportunity_detail.collect()
    assert len(deals) == star.fact_opportunities.count()
    assert fresh.opportunity_detail.where(F.col("close_month") == month).count() == sum(r.close_month == month for r in deals)


def growth(series, months):
    """Change against the month before in the calendar; blank without one."""
    out = {}
    for before, now in zip(months, months[1:]):
        a, b = series.get(before), series.get(now, 0)
        if a:
            out[now] = (b - a) / a
    return out


def test_month_before_in_a_filtered_request(reports, placed, tables):
    leads, deals, _ = placed
    months = sorted(tables["dim_date"].year_month.unique())
    two = ("BUILDING", "MACHINERY")
    got = reports.evaluator.evaluate(
        ["leads", "mom_leads", "mom_revenue", "share_of_leads", "won_revenue"], ["DimDate.year_month"],
        {"DimDate.year": lambda c: c == 1997, "DimChannel.channel_name": lambda c: c.isin(*two)},
    ).toPandas().set_index("year_month")
    mine = leads[leads.channel.isin(two)].groupby("month").size()
    every = leads.groupby("month").size()
    won = deals[(deals.is_won == 1) & deals.channel.isin(two)].groupby("month").won_value.sum().astype(float)
    change, change_won = growth(mine.to_dict(), months), growth(won.to_dict(), months)
    assert set(got.index) == {m for m in months if m.startswith("1997")} & ({*mine.index} | {*every.index} | {*won.index} | {*change} | {*change_won})
    for m, row in got.iterrows():
        assert (row.leads if pd.notna(row.leads) else 0) == mine.get(m, 0)
        for value, want in ((row.mom_leads, change.get(m)), (row.mom_revenue, change_won.get(m)), (row.won_revenue, won.get(m))):
            assert value == pytest.approx(want) if want is not None else pd.isna(value)
        if m in mine.index:
            assert row.share_of_leads == pytest.approx(mine[m] / every[m])


@pytest.mark.parametrize("by", [(), ("DimChannel.channel_name",), ("DimDate.year_month",), ("DimDate.year", "DimChannel.channel_name")])
def test_last_period_and_distinct_members(reports, placed, tables, by):
    _, _, billing = placed
    billing = billing.assign(year=billing.month.str[:4].astype(int), all="all")
    keys = [{"DimChannel.channel_name": "channel", "DimDate.year_month": "month", "DimDate.year": "year"}[c] for c in by] or ["all"]
    got = reports.evaluator.evaluate(["mrr", "mrr_end_of_period", "active_customers", "churned_customers"], by).toPandas()
    names = [c.split(".")[1] for c in by]
    found = {tuple(r[n] for n in names) or ("all",): r for _, r in got.iterrows()}
    groups = {k if isinstance(k, tuple) else (k,): g for k, g in billing.groupby(keys)}
    assert set(found) <= set(groups)
    for k, g in groups.items():
        active = g[g.is_active == 1]
        if k in found:
            row = found[k]
            assert (row.mrr if pd.notna(row.mrr) else 0) == pytest.approx(float(active.mrr.sum()))
            assert (row.active_customers if pd.notna(row.active_customers) else 0) == active.customer_id.nunique()
            last = active[active.month_key == g.month_key.max()]
            assert (row.mrr_end_of_period if pd.notna(row.mrr_end_of_period) else 0) == pytest.approx(float(last.mrr.sum()))
            assert row.churned_customers == g.is_churned.sum()


def test_values_that_replace_a_filter_beside_others(reports, placed):
    """Paid customers look at paid channels whatever the request filters and groups by."""
    _, deals, _ = placed
    won = deals[deals.is_won == 1]
    got = reports.evaluator.evaluate(
        ["customers", "paid_cac", "non_paid_revenue_share", "won_revenue"], ["DimDate.year", "DimChannel.is_paid"]
    ).toPandas()
    by_year = won[won.paid == 0].assign(year=won.month.str[:4].astype(int)).groupby("year").won_value.sum().astype(float)
    own = won.assign(year=won.month.str[:4].astype(int)).groupby(["year", "paid"])
    revenue = own.won_value.sum().astype(float)
    assert len(got) > 5
    for _, r in got.iterrows():
        key = (r.year, r.is_paid)
        assert (r.customers if pd.notna(r.customers) else 0) == (own.size().get(key, 0))
        if key in revenue.index and r.year in by_year.index:
            assert r.non_paid_revenue_share == pytest.approx(by_year[r.year] / revenue[key])


def test_measures_together_are_those_alone(reports):
    measures = [*registry.FACT_MEASURES, *registry.MONTHLY_CHANGE]
    by, filters = ["DimDate.year_month", "DimChannel.is_paid"], {"DimChannel.channel_name": lambda c: c != "BUILDING"}
    whole = reports.evaluator.evaluate(measures, by, filters).toPandas().set_index(["year_month", "is_paid"])
    for m in ("leads", "mom_leads", "share_of_customers", "paid_spend", "mrr_end_of_period", "active_customers", "cac"):
        alone = reports.evaluator.evaluate([m], by, filters).toPandas().set_index(["year_month", "is_paid"])[m].dropna()
        pd.testing.assert_series_equal(whole[m].dropna().sort_index(), alone.sort_index(), check_dtype=False)


def test_evaluators_are_used_by_threads(reports):
    from funnelworks.session import together

    e = reports.evaluator
    jobs = [lambda c=c: e.evaluate(["leads", "customers"], [c]).columns for c in ("DimDate.year_month", "DimRegion.region_name")] * 8
    assert together(jobs) == [["year_month", "leads", "customers"], ["region_name", "leads", "customers"]] * 8
