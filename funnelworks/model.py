"""The containers every plan works on: lazily built, memoised tables by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import MONTH, PLACED_BY

STAR_TABLES = [
    "dim_date",
    "dim_channel",
    "dim_campaign",
    "dim_region",
    "dim_customer",
    "fact_marketing_daily",
    "fact_leads",
    "fact_opportunities",
    "fact_customer_monthly",
]
EXPORT_TABLES = ["marketing", "leads", "opportunities", "customers", "customer_monthly"]


def month_of(key: Column | str) -> Column:
    """The month (YYYYMM) of a date key (YYYYMMDD)."""
    return F.floor((F.col(key) if isinstance(key, str) else key) / 100).cast("int")


class Tables:
    """Named DataFrames, each built on first use. Subclasses say which names exist.

    ``months`` has the tables that are stored by month, with the column MONTH; a condition on it leaves out whole folders.
    """

    names: list[str] = []

    def __init__(
        self,
        builders: Mapping[str, Callable[[], DataFrame]],
        months: Mapping[str, Callable[[], DataFrame]] | None = None,
    ):
        missing = set(self.names) - set(builders)
        if missing:
            raise ValueError(f"missing tables: {sorted(missing)}")
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        self._months = dict(months or {})

    def by_month(self, name: str) -> DataFrame | None:
        """The table with the column MONTH, or None if nothing places its rows in time."""
        return self._months[name]() if name in self._months else None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


class Star(Tables):
    """Clean star schema plus the report period, as inclusive (first, last) date keys."""

    names = STAR_TABLES

    def __init__(self, builders, period: tuple[int, int], months: Mapping[str, Callable[[], DataFrame]] | None = None):
        super().__init__(builders, months)
        self.period = period

    def by_month(self, name: str) -> DataFrame | None:
        stored = super().by_month(name)
        if stored is None and name in PLACED_BY:
            return self[name].withColumn(MONTH, month_of(F.expr(PLACED_BY[name])))
        return stored

    def in_months(self, name: str, first: int, last: int) -> DataFrame:
        """Rows of a fact in the months of two date keys and between them."""
        return self.by_month(name).where(F.col(MONTH).between(first // 100, last // 100)).drop(MONTH)

    @property
    def spark(self) -> SparkSession:
        return self.dim_channel.sparkSession


class Exports(Tables):
    """Raw tool exports; every table carries its ingest position in ``_pos``."""

    names = EXPORT_TABLES


class Reference(Tables):
    """Reference data the labels are matched to. ``synonyms`` has (label, name) rows for regions."""

    names = ["channels", "campaigns", "regions", "synonyms"]
