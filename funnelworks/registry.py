"""Every query by name: a function of (spark, folder of base tables) that returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.numeric import MONEY, dbl, n_rows
from .model import STAR_TABLES, Exports, Reference
from .operators.constraints import check_constraints
from .operators.dedupe import COPIES, POSITION, collapse_exact, keep_first
from .operators.median import twice_median
from .operators.rows import union_all
from .plans import quality
from .plans.analyses import ANALYSES
from .plans.build import EXPORTS, Build, build, read_published_views
from .plans.cleaning import Cleaning
from .plans.delivered import star_as_delivered
from .plans.integrity import integrity_tests
from .plans.measures import MEASURES
from .plans.model import ReportModel
from .plans.reconcile import kpi_summary, reconciliation, reconciliation_summary
from .plans.reports import DATASETS, Reports
from .plans.suite import run_log
from .plans.views import Views
from .schemas import REFERENCE_SCHEMAS
from .session import together, work_dir
from .sources.exports import (
    VIEW_NAMES,
    corrupt_rows,
    read_exports,
    read_json,
    read_model,
    read_sample,
    read_view,
    read_reference,
    sample,
    write_export,
    write_reference,
)
from .sources.messy import MessyExports
from .sources.tables import read_published, read_star, write_star, written
from .sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


@lru_cache(maxsize=8)
def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, folder)


@lru_cache(maxsize=8)
def _messy(spark: SparkSession, folder: str) -> MessyExports:
    return MessyExports(_warehouse(spark, folder))


def spans(spark: SparkSession, folder: str) -> tuple[DataFrame, tuple[int, int]]:
    """Bounds of the calendar and the report period, both read from the tables."""
    w = _warehouse(spark, folder)
    return w.days(), w.period()


@lru_cache(maxsize=8)
def delivered(spark: SparkSession, folder: str) -> tuple[Exports, Reference]:
    """The raw exports as the tools would deliver them, for jobs that read them many times: each is written once, when it is
    first asked for."""
    messy = MessyExports(Warehouse(spark, folder, keep_lines=True))
    target = work_dir(spark, "exports")
    derived = messy.exports()
    raw = Exports({n: lambda n=n: written(derived[n], f"{target}/{n}") for n in Exports.names})
    return raw, messy.reference()


@lru_cache(maxsize=8)
def _cleaning(spark: SparkSession, folder: str) -> Cleaning:
    """Cleaning of the delivered exports. Files are what cleaning starts from: were the exports only a plan, filters
    on their columns would sink through it and be evaluated per line item."""
    return Cleaning(*delivered(spark, folder), *spans(spark, folder))


@lru_cache(maxsize=8)
def built(spark: SparkSession, folder: str) -> Build:
    """One full rebuild per session and folder: the audits and suites below all look at its published tables."""
    raw, reference = delivered(spark, folder)
    together([lambda: [raw[n] for n in ("opportunities", "customers", "customer_monthly")], lambda: raw.leads, lambda: raw.marketing])
    return build(spark, Cleaning(raw, reference, *spans(spark, folder)), work_dir(spark, "star"))


@lru_cache(maxsize=8)
def _reports(spark: SparkSession, folder: str) -> Reports:
    b = built(spark, folder)
    return Reports(b.model, b.views)


def _on_reports(name: str, plan: Callable[[Reports], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(_reports(spark, folder))


def _on_cleaning(name: str, plan: Callable[[Cleaning], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(_cleaning(spark, folder))


def _on_build(name: str, plan: Callable[[Build], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(built(spark, folder))


def _on_built_views(name: str, plan: Callable[[Views], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(built(spark, folder).views)


_on_built_views("v0_lead_outcomes", lambda v: v.lead_outcomes.withColumn("won_value", dbl("won_value")))
_on_built_views("v1_channel_performance", lambda v: v.channel_performance)
_on_built_views("v2_campaign_performance", lambda v: v.campaign_performance)
_on_built_views("v3_funnel", lambda v: v.funnel)
_on_built_views("v4_monthly_management", lambda v: v.monthly_management)
_on_built_views("v5_opportunity_detail", lambda v: v.opportunity_detail)
_on_built_views("v6_customer_value", lambda v: v.customer_value)

for _ident, (_group, _title, _plan) in ANALYSES.items():
    _on_built_views(f"{_ident}_{_plan.__name__}", _plan)


# ---- raw exports, cleaning, quality
def _plain(df: DataFrame) -> DataFrame:
    """Money as double and days as ISO text: the types the results are exchanged in."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            dbl(c).alias(c) if k.startswith("decimal") else F.col(c).cast("string").alias(c) if k == "date" else F.col(c)
            for c, k in kinds.items()
        ]
    )


for _name in Exports.names:
    QUERIES[f"raw_{_name}"] = lambda spark, folder, n=_name: _plain(getattr(_messy(spark, folder), n)())
_on_cleaning("clean_marketing", lambda c: _plain(c.marketing))
_on_cleaning("clean_leads", lambda c: _plain(c.leads))
_on_cleaning("clean_opportunities", lambda c: _plain(c.opportunities))
_on_cleaning("clean_customers", lambda c: _plain(c.customers))
_on_cleaning("clean_customer_monthly", lambda c: _plain(c.customer_monthly))
_on_cleaning("clean_dim_date", lambda c: _plain(c.star().dim_date))

# ---- the rebuild and its audit
_on_build("cleaning_log", lambda b: b.log)
_on_build("dq_checks", lambda b: b.checks)
_on_build("dq_row_counts", lambda b: b.row_counts)
_on_build("dq_totals", lambda b: quality.totals(b.checks))
_on_build("constraints", lambda b: b.constraints)
_on_build("integrity_tests", lambda b: b.integrity)


# ---- report model, measures and report datasets, over the published star
for _name in ReportModel.names:
    _on_reports(f"model_{_name}", lambda r, n=_name: _plain(r.model[n]))

MONTHLY_CHANGE = ["mom_leads", "mom_revenue"]
TOTAL_MEASURES = [m for m in MEASURES if m not in MONTHLY_CHANGE]
FACT_MEASURES = [
    m for m in TOTAL_MEASURES if MEASURES[m].home.startswith("Fact") and not m.startswith("campaigns_to")
]
BY_REGION = [
    m
    for m in FACT_MEASURES
    if MEASURES[m].home != "FactMarketingDaily" and m != "session_to_lead_rate"
]
_on_reports("measures_total", lambda r: r.evaluator.evaluate(TOTAL_MEASURES))
_on_reports("measures_by_channel", lambda r: r.evaluator.evaluate(FACT_MEASURES, ["DimChannel.channel_name"]))
_on_reports("measures_by_campaign", lambda r: r.evaluator.evaluate(FACT_MEASURES, ["DimCampaign.campaign_name"]))
_on_reports("measures_by_region", lambda r: r.evaluator.evaluate(BY_REGION, ["DimRegion.region_name"]))
_on_reports(
    "measures_by_month", lambda r: r.evaluator.evaluate([*FACT_MEASURES, *MONTHLY_CHANGE], ["DimDate.year_month"])
)
_on_reports(
    "measures_filtered",
    lambda r: r.evaluator.evaluate(
        ["leads", "customers", "share_of_leads", "share_of_customers", "mom_leads", "mrr_end_of_period", "paid_spend"],
        ["DimDate.year_month", "DimChannel.channel_name"],
        {
            "DimDate.year": lambda c: c == 1998,
            "DimChannel.channel_name": lambda c: c.isin("BUILDING", "FURNITURE", "MACHINERY"),
        },
    ),
)
for _ident in DATASETS:
    _on_reports(_ident, lambda r, i=_ident: r.dataset(i))
_on_reports("rd13", lambda r: r.evaluator.evaluate(["leads", "mqls", "sqls", "opportunities", "customers"]))
_on_reports("rd21", lambda r: r.funnel())
_on_reports("rd23", lambda r: r.conversion_by_band())
_on_reports("rd62", lambda r: r.table("DataQualityRowCounts"))
_on_reports("rd63", lambda r: r.table("CleaningLog"))
_on_reports(
    "rd23_sliced",
    lambda r: r.conversion_by_band(
        {"DimDate.year_month": lambda c: c.between("1996-01", "1996-12"), "DimChannel.is_paid": lambda c: c == 1}
    ),
)
_on_reports("rd_channel_rank", lambda r: r.channel_rank())
_on_reports("rd_revenue_trend", lambda r: r.revenue_trend())
_on_reports("rd_biggest_open", lambda r: r.biggest_open())
_on_reports("reconciliation", lambda r: reconciliation(r.model, r.views))
_on_reports("reconciliation_summary", lambda r: reconciliation_summary(reconciliation(r.model, r.views)))
_on_built_views("kpi_summary", kpi_summary)
_on_built_views("run_log", lambda v: run_log(v).drop("ms"))

# ---- sources and sinks
for _name in Exports.names:
    _on_cleaning(f"sample_{_name}", lambda c, n=_name: _plain(sample(c.raw[n])))


@lru_cache(maxsize=8)
def _from_csv(spark: SparkSession, folder: str) -> Cleaning:
    """Cleaning of the exports as CSV files: each written once, when it is first asked for, and read back with the positions
    of the files."""
    _, reference = delivered(spark, folder)
    return Cleaning(Exports({n: partial(_csv_export, spark, folder, n) for n in Exports.names}), reference, *spans(spark, folder))


def _csv_export(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_exports(spark, _csv_folder(spark, folder, name))[name]


def _on_csv(name: str, plan: Callable[[Cleaning], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(_from_csv(spark, folder))


_on_csv("csv_marketing", lambda c: _plain(c.marketing))
_on_csv("csv_leads", lambda c: _plain(c.leads))
_on_csv("csv_opportunities", lambda c: _plain(c.opportunities))
_on_csv("csv_customer_monthly", lambda c: _plain(c.customer_monthly))
_on_csv("csv_customers", lambda c: _plain(c.customers))


@lru_cache(maxsize=8)
def _csv_target(spark: SparkSession, folder: str) -> str:
    return work_dir(spark, "csv")


@lru_cache(maxsize=8 * len(Exports.names))
def _csv_folder(spark: SparkSession, folder: str, name: str) -> str:
    """The folder of the CSV files, with this export in it."""
    target = _csv_target(spark, folder)
    write_export(delivered(spark, folder)[0], name, target)
    return target


def _csv_folders(spark: SparkSession, folder: str) -> str:
    """The folder of the CSV files, with all exports in it."""
    return {_csv_folder(spark, folder, n) for n in Exports.names}.pop()


@lru_cache(maxsize=8)
def _reference_folder(spark: SparkSession, folder: str) -> str:
    target = work_dir(spark, "reference")
    write_reference(delivered(spark, folder)[1], target)
    return target


for _name in REFERENCE_SCHEMAS:
    QUERIES[f"csv_{_name}"] = lambda spark, folder, n=_name: _plain(read_reference(spark, _reference_folder(spark, folder))[n])
QUERIES["csv_corrupt_rows"] = lambda spark, folder: corrupt_rows(spark, _csv_folders(spark, folder))


def _exported(spark: SparkSession, folder: str) -> str:
    """Everything that a build hands to other tools, as it was published."""
    return f"{built(spark, folder).folder}/{EXPORTS}"


def _on_exported(name: str, plan: Callable[[SparkSession, str, Reports], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(spark, _exported(spark, folder), _reports(spark, folder))


for _name in VIEW_NAMES:
    _on_exported(
        f"export_{_name}", lambda s, f, r, n=_name: read_view(s, f"{f}/views", n, dict(getattr(r.views, n).dtypes))
    )
for _name in ReportModel.names:
    _on_exported(f"import_{_name}", lambda s, f, r, n=_name: _plain(read_model(s, f"{f}/model")[n]))
_on_exported(
    "kpi_json",
    lambda s, f, r: read_json(s, f"{f}/kpi", ", ".join(f"{c} {k}" for c, k in kpi_summary(r.views).dtypes)),
)


def published_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, name, rows) of everything that a build publishes, read back from where it was published."""
    b = built(spark, folder)
    star, views, exported = read_published(spark, b.folder), read_published_views(spark, b.folder), _exported(spark, folder)
    kinds = lambda n: dict(getattr(views, n).dtypes)
    read = {
        **{("star", n): star[n] for n in STAR_TABLES},
        **{("view", n): read_view(spark, f"{exported}/views", n, kinds(n)) for n in VIEW_NAMES},
        **{("model", n): read_model(spark, f"{exported}/model")[n] for n in ReportModel.names},
        **{("sample", n): read_sample(spark, f"{exported}/samples/{n}", n) for n in Exports.names},
    }
    return union_all(
        [df.agg(n_rows().alias("rows")).select(F.lit(k).alias("kind"), F.lit(n).alias("name"), "rows") for (k, n), df in read.items()]
    )


QUERIES["published"] = published_rows


# ---- audits on rows that were not cleaned: they have to find the faults
@lru_cache(maxsize=8)
def _as_delivered(spark: SparkSession, folder: str) -> Views:
    raw, reference = delivered(spark, folder)
    star = star_as_delivered(raw, reference, _cleaning(spark, folder))
    target = work_dir(spark, "delivered-star")
    write_star(star, target)
    return Views(read_star(spark, target, star.period))


def _on_delivered(name: str, plan: Callable[[Views], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(_as_delivered(spark, folder))


_on_delivered("delivered_constraints", lambda v: check_constraints(v.star))
_on_delivered("delivered_integrity_tests", integrity_tests)
for _ident in ("q25b", "q25c", "q25d"):
    _on_delivered(f"delivered_{_ident}", ANALYSES[_ident][2])


def _on_tables(name: str, plan: Callable[[Warehouse], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plan(Warehouse(spark, folder))


# ---- general operators on base tables
def first_line(w: Warehouse) -> DataFrame:
    """The first of the lines that share an order and line number, in the order of all their other columns."""
    lines = w.table("lineitem")
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    placed = lines.withColumn(POSITION, F.struct(*[F.col(c) for c in rest]))
    return keep_first(placed, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", F.col(COPIES).alias("copies")
    )


def exact_copies(w: Warehouse) -> DataFrame:
    """Distinct (order status, priority, day) combinations with the first order of each and its copies."""
    orders = w.table("orders").select(
        "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.col("o_orderkey").alias(POSITION),
    )
    return collapse_exact(orders).withColumnsRenamed({POSITION: "first_order", COPIES: "copies"})


def price_median(w: Warehouse) -> DataFrame:
    """Exact median line price per return flag, a key that holds a third of all lines."""
    prices = w.table("lineitem").select("l_returnflag", F.col("l_extendedprice").cast(MONEY).alias("price"))
    return twice_median(prices, "l_returnflag", "price").select(
        "l_returnflag", (dbl("twice_median") / 2).alias("median_price")
    )


_on_tables("keep_first_lines", first_line)
_on_tables("collapse_exact_orders", exact_copies)
_on_tables("median_price", price_median)
