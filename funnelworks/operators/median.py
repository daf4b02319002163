"""Exact grouped median without collecting a group.

The built-in median keeps every distinct value of a group in one aggregation buffer. Here the values of a group
stay spread over the cluster: they are counted per (key, value), a log-scaled histogram of at most a few thousand
buckets per key tells which bucket holds the middle rank, and only the values of that bucket - which differ by about
one per cent - are ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lookup import one_per_member

STEPS_PER_DOUBLING = 64


def _bucket(value):
    """Non-decreasing in value, about 1.1 % wide on each side of zero.

    It is visibly never NULL, so that the join below adds no filter to one use of the counts only: both uses stay the
    same plan and share one exchange, and the input is read once.
    """
    x = value.cast("double")
    step = (F.signum(x) * F.floor(F.log2(F.abs(x) + F.lit(1.0)) * STEPS_PER_DOUBLING)).cast("int")
    return F.coalesce(step, F.lit(0))


def twice_median(
    df: DataFrame, key: str, value: str, members: DataFrame | None = None, out: str = "twice_median"
) -> DataFrame:
    """(key, lower middle + upper middle) for non-null keys and values.

    Twice the median is returned because it has the scale of the input: exact for decimals, no rounding needed.
    ``members`` is the reference table the keys come from, if there is one: when it is small, the buckets with the
    middle ranks (two per key at most) are broadcast and the counts are not shuffled again.
    """
    counts = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return twice_median_of_counts(counts, key, value, members, out)


def twice_median_of_counts(
    counts: DataFrame, key: str, value: str, members: DataFrame | None = None, out: str = "twice_median"
) -> DataFrame:
    """The same of values that have been counted: one row per key and value, with the count ``_n``."""
    counts = counts.select(key, value, "_n").withColumn("_bucket", _bucket(F.col(value)))
    along = Window.partitionBy(key).orderBy("_bucket")
    whole = Window.partitionBy(key)
    middle = (
        counts.groupBy(key, "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(along), "_all": F.sum("_n").over(whole)})
        .select(
            key,
            "_bucket",
            (F.col("_upto") - F.col("_n")).alias("_before"),
            F.expr("(_all + 1) div 2").alias("_low"),
            F.expr("(_all + 2) div 2").alias("_high"),
            "_upto",
        )
        .where("_upto >= _low AND _before < _high")
        .drop("_upto")
    )
    if members is not None:
        middle = one_per_member(middle, members)
    ranked = (
        counts.join(middle, [key, "_bucket"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(Window.partitionBy(key, "_bucket").orderBy(value)))
        .where(F.expr("_end >= _low AND _end - _n < _high"))
    )
    return ranked.groupBy(key).agg((F.min(value) + F.max(value)).alias(out))
