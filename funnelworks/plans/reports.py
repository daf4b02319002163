"""The datasets behind the report pages: each is a set of measures over a grouping, sorted as shown."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import score_band
from ..functions.numeric import n_rows, ratio
from .measures import Evaluator, Predicate
from .model import UNASSIGNED, ReportModel
from .views import Views

MONTH, CHANNEL, CAMPAIGN = "DimDate.year_month", "DimChannel.channel_name", "DimCampaign.campaign_name"


@dataclass(frozen=True)
class Dataset:
    title: str
    measures: Sequence[str]
    by: Sequence[str] = ()
    order: Callable[[], list[Column]] = list


def _down(column: str) -> Callable[[], list[Column]]:
    return lambda: [F.col(column).desc_nulls_last()]


def _up(column: str) -> Callable[[], list[Column]]:
    return lambda: [F.col(column).asc_nulls_last()]


STAGES = ["leads", "mqls", "sqls", "opportunities", "customers"]
RATES = ["session_to_lead_rate", "lead_to_mql_rate", "mql_to_sql_rate", "sql_to_customer_rate", "lead_to_customer_rate"]

DATASETS: dict[str, Dataset] = {
    # headline cards of the six pages
    "rd01": Dataset(
        "Executive cards", ["total_spend", "leads", "customers", "won_revenue", "cac", "lead_to_customer_rate"]
    ),
    "rd02": Dataset("Funnel cards", ["sessions", *STAGES]),
    "rd03": Dataset(
        "Campaign cards",
        ["paid_spend", "paid_cac", "non_paid_revenue_share", "campaigns_to_scale", "campaigns_to_reduce"],
    ),
    "rd04": Dataset(
        "Revenue cards", ["won_revenue", "win_rate", "average_deal_value", "average_sales_cycle", "open_pipeline"]
    ),
    "rd05": Dataset(
        "Customer cards", ["customers", "mrr_end_of_period", "arr_run_rate", "churned_customers", "churn_rate"]
    ),
    "rd06": Dataset(
        "Quality cards",
        ["rows_loaded", "rows_removed", "issues_found_raw", "blocking_errors_left", "documented_warnings"],
    ),
    # executive overview
    "rd11": Dataset("Revenue and leads by month", ["won_revenue", "leads"], [MONTH], _up("year_month")),
    "rd12": Dataset("Revenue by channel", ["won_revenue"], [CHANNEL], _down("won_revenue")),
    "rd14": Dataset(
        "Share of leads and customers", ["share_of_leads", "share_of_customers"], [CHANNEL], _down("share_of_customers")
    ),
    # acquisition funnel
    "rd22": Dataset("Stage conversion by channel", RATES, [CHANNEL], _down("lead_to_customer_rate")),
    "rd24": Dataset("Average score by channel", ["avg_lead_score"], [CHANNEL], _down("avg_lead_score")),
    # channels and campaigns
    "rd31": Dataset("Campaign scatter", ["cac", "won_revenue", "leads"], [CAMPAIGN, "DimCampaign.recommendation"]),
    "rd32": Dataset(
        "Channel ranking",
        ["total_spend", "leads", "cpl", "cac", "won_revenue", "revenue_per_spend"],
        [CHANNEL],
        _down("won_revenue"),
    ),
    # revenue
    "rd41": Dataset("Revenue by close month", ["won_revenue"], [MONTH], _up("year_month")),
    "rd42": Dataset(
        "Opportunities by channel and status",
        ["opportunities"],
        [CHANNEL, "FactOpportunities.status"],
        _down("opportunities"),
    ),
    "rd43": Dataset(
        "Sales cycle by company size", ["average_sales_cycle"], ["FactOpportunities.company_size"], _up("company_size")
    ),
    "rd44": Dataset(
        "Deal value by company size", ["average_deal_value"], ["FactOpportunities.company_size"], _up("company_size")
    ),
    "rd45": Dataset("Open value by campaign", ["open_pipeline"], [CAMPAIGN], _down("open_pipeline")),
    # customers
    "rd51": Dataset("Churn and MRR by month", ["churned_customers", "mrr"], [MONTH], _up("year_month")),
    "rd52": Dataset("New customers by channel", ["customers"], [CHANNEL], _down("customers")),
    "rd53": Dataset("New customers by region", ["customers"], ["DimRegion.region_name"], _down("customers")),
    "rd54": Dataset(
        "MRR by company size", ["mrr_end_of_period"], ["DimCustomer.company_size"], _up("company_size")
    ),
    "rd55": Dataset(
        "MRR by business type", ["mrr_end_of_period"], ["DimCustomer.business_type"], _down("mrr_end_of_period")
    ),
    # data quality
    "rd61": Dataset(
        "Issues per check",
        ["issues_found_raw", "issues_after_cleaning"],
        ["DataQualityChecks.description"],
        _down("issues_found_raw"),
    ),
}


class Reports:
    """Report datasets over one model. ``filters`` are the month, channel and campaign slicers of the pages."""

    def __init__(self, model: ReportModel, views: Views):
        self.model = model
        self.views = views
        self.evaluator = Evaluator(model)

    def dataset(self, ident: str, filters: dict[str, Predicate] | None = None) -> DataFrame:
        d = DATASETS[ident]
        result = self.evaluator.evaluate(d.measures, d.by, filters)
        order = d.order()
        ties = [F.col(c.split(".")[1]).asc_nulls_last() for c in d.by]
        return result.orderBy(*order, *ties) if d.by else result

    def funnel(self, filters: dict[str, Predicate] | None = None) -> DataFrame:
        """RD13, RD21: the five totals, each with its share of the stage before."""
        one_row = self.evaluator.evaluate(STAGES, (), filters)
        stages = F.array(
            *[
                F.struct(F.lit(i).alias("stage_order"), F.lit(s).alias("stage"), F.col(s).alias("volume"))
                for i, s in enumerate(STAGES, 1)
            ]
        )
        before = F.lag("volume").over(Window.orderBy("stage_order"))
        return (
            one_row.select(F.inline(stages))
            .withColumn("share_of_previous", ratio("volume", before))
            .orderBy("stage_order")
        )

    def _sliced(self, rows: DataFrame, filters: dict[str, Predicate] | None, keys: dict[str, tuple[str, str]]) -> DataFrame:
        """The rows that the filters leave; keys: dimension -> (column of the rows, key of the dimension). Filters of other
        tables do not reach the rows."""
        for column, test in (filters or {}).items():
            table, name = column.split(".")
            if name not in self.model[table].columns:
                raise ValueError(f"no column {column!r} in the model")
            if table in keys:
                own, key = keys[table]
                members = self.model[table].where(test(F.col(name))).select(F.col(key).alias("_member")).distinct()
                own = F.coalesce(own, F.lit(UNASSIGNED)) if table == "DimCampaign" else F.col(own)
                rows = rows.join(members, own == F.col("_member"), "left_semi")
        return rows

    def table(self, name: str, filters: dict[str, Predicate] | None = None) -> DataFrame:
        """RD62, RD63: a table of the model as it is, with the filters on its own columns."""
        rows = self.model[name]
        for column, test in (filters or {}).items():
            table, own = column.split(".")
            if own not in self.model[table].columns:
                raise ValueError(f"no column {column!r} in the model")
            rows = rows.where(test(F.col(own))) if table == name else rows
        return rows

    def conversion_by_band(self, filters: dict[str, Predicate] | None = None) -> DataFrame:
        """RD23: customers among the leads of a score band. Counted on leads: a band says nothing about deals."""
        keys = {
            "DimDate": ("created_date_key", "date_key"),
            "DimChannel": ("channel_id", "channel_id"),
            "DimCampaign": ("campaign_id", "campaign_id"),
            "DimRegion": ("region_id", "region_id"),
        }
        months = {c: f for c, f in (filters or {}).items() if c == MONTH}
        rows = self.views.lead_outcomes  # stored by month
        for test in months.values():
            rows = rows.where(test(F.col("year_month")))
        rest = {c: f for c, f in (filters or {}).items() if c not in months}
        return (
            self._sliced(rows, rest, keys).groupBy(score_band("lead_score").alias("score_band"))
            .agg(ratio(F.sum("is_customer"), n_rows()).alias("lead_to_customer_rate"))
            .orderBy("score_band")
        )

    def channel_rank(self, filters: dict[str, Predicate] | None = None) -> DataFrame:
        """Channels ranked by won revenue."""
        ranked = self.evaluator.evaluate(["won_revenue"], [CHANNEL], filters)
        return ranked.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("won_revenue").desc_nulls_last())))

    def revenue_trend(self, filters: dict[str, Predicate] | None = None) -> DataFrame:
        """Won revenue by month with the mean of the last three months."""
        last_three = Window.orderBy("year_month").rowsBetween(-2, Window.currentRow)
        exact = F.col("won_revenue").cast("decimal(38,2)")
        return self.evaluator.evaluate(["won_revenue"], [MONTH], filters).withColumn(
            "three_month_mean", ratio(F.sum(exact).over(last_three), F.count(exact).over(last_three))
        )

    def biggest_open(self, k: int = 6, filters: dict[str, Predicate] | None = None) -> DataFrame:
        """The k campaigns with the most open value."""
        return self.dataset("rd45", filters).limit(k)
