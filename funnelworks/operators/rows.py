"""One-row results: turning their columns into rows, and their values into scalars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of(one_row: DataFrame, **columns: list[Column]) -> DataFrame:
    """Stack parallel lists of columns of a (usually one-row) frame into rows: one scan, no union."""
    names = list(columns)
    structs = [
        F.struct(*[c.alias(n) for n, c in zip(names, values)]) for values in zip(*columns.values(), strict=True)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def anti_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row, one column ``n``: rows of left without a partner; a NULL key has none.

    Both sides are reduced to one row per key before they are shuffled, so neither a key that many rows point to nor
    one that many rows repeat ends up in one task. The join needs the same partitioning as the two reductions.
    """
    pointing = left.groupBy(F.col(left_key).alias("_lk")).agg(F.count(F.lit(1)).alias("_c"))
    keys = right.select(F.col(right_key).alias("_rk")).distinct()
    unmatched = pointing.join(keys, F.col("_lk") == F.col("_rk"), "left_anti")
    return unmatched.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"))
