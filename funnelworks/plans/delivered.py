"""The delivered exports in the shape of the star, with no rule applied: what audits and tests find when nothing is cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, month_key, parse_day, parse_moment
from ..functions.numeric import flag
from ..model import Exports, Reference, Star
from ..operators.lookup import label_map, map_label
from ..schemas import STAR_SCHEMAS
from .cleaning import Cleaning


def star_as_delivered(raw: Exports, ref: Reference, cleaning: Cleaning) -> Star:
    """Labels are matched and dates are read, as columns need it; faults stay. Deals and customers have no attributes of
    their lead, which only the cleaning adds."""
    channel = label_map(ref.channels, "channel_name", "channel_id")
    campaign = label_map(ref.campaigns, "campaign_name", "campaign_id")
    region = label_map(ref.regions, "region_name", "region_id", ref.synonyms)
    created, closed = parse_moment("created_at"), parse_moment("closed_at")

    def shaped(table: str, df: DataFrame, **columns: Column) -> DataFrame:
        kinds = STAR_SCHEMAS[table]
        value = lambda c: columns.get(c, F.col(c) if c in df.columns else F.lit(None))
        return df.select(*[value(c).cast(k).alias(c) for c, k in kinds.items()])

    def marketing() -> DataFrame:
        df = map_label(map_label(raw.marketing, "channel", channel, "channel_id"), "campaign", campaign, "campaign_id")
        return shaped("fact_marketing_daily", df, date_key=date_key(parse_day("date")))

    def leads() -> DataFrame:
        df = map_label(map_label(raw.leads, "channel", channel, "channel_id"), "campaign", campaign, "campaign_id")
        return shaped("fact_leads", map_label(df, "region", region, "region_id"), created_date_key=date_key(created))

    def deals() -> DataFrame:
        return shaped(
            "fact_opportunities", raw.opportunities, created_date_key=date_key(created), close_date_key=date_key(closed),
            status=F.col("stage"), is_won=flag(F.col("stage") == "Won"), value_imputed=F.lit(0),
            sales_cycle_days=F.date_diff(closed, created),
        )

    def customers() -> DataFrame:
        return shaped("dim_customer", raw.customers, acquisition_date_key=date_key(parse_moment("start_date")))

    def months() -> DataFrame:
        return shaped(
            "fact_customer_monthly", raw.customer_monthly, month_key=month_key("year_month"),
            is_active=flag(F.col("status") == "active"), is_churned=flag(F.col("status") == "churned"),
        )

    clean = cleaning.star()
    return Star(
        {
            **{name: (lambda n=name: clean[n]) for name in ("dim_date", "dim_channel", "dim_campaign", "dim_region")},
            "dim_customer": customers,
            "fact_marketing_daily": marketing,
            "fact_leads": leads,
            "fact_opportunities": deals,
            "fact_customer_monthly": months,
        },
        clean.period,
    )
