"""Calendar keys and tolerant date parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numeric import col


def date_key(d: str | Column) -> Column:
    """Date -> integer YYYYMMDD, NULL kept."""
    c = col(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def parse_day(text: str | Column) -> Column:
    """Strict year-month-day text (unpadded parts allowed); anything else, or an impossible day, is NULL."""
    c = F.trim(col(text))
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d"))


def parse_moment(text: str | Column) -> Column:
    """Year-month-day text with an optional time of day; unparseable text is NULL."""
    c = F.trim(col(text))
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), c.try_cast("timestamp_ntz"))


def whole_days(start: Column, end: Column) -> Column:
    return F.timestamp_diff("DAY", start, end).cast("int")


def month_key(year_month: str | Column) -> Column:
    """'YYYY-MM' -> YYYYMM01, the key of the first day of the month."""
    return F.concat(F.replace(col(year_month), F.lit("-"), F.lit("")), F.lit("01")).cast("int")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from first to last (inclusive ISO dates), with the reporting attributes of the day."""
    return calendar_between(spark.sql("SELECT to_date(:first) AS first, to_date(:last) AS last", args={"first": first, "last": last}))


def calendar_between(bounds: DataFrame) -> DataFrame:
    """The calendar of a one-row frame with the dates ``first`` and ``last``; empty when they are NULL."""
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("d"))
    d = F.col("d")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("week"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
    )
