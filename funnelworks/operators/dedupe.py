"""Duplicate removal that does not pile a hot key into one task.

Both operators are hash aggregations: every map task first reduces its own rows to one per key, so a key that holds a third of
the input still sends one row per map task through the shuffle. Keeping a whole row does not carry rows through the
aggregation: it finds the keys that occur more than once and their first positions, all of fixed width, and only these keys, a
written table of known size, are joined to the rows. They also report how many copies each kept row stands for, which is
what the cleaning log needs - no second pass for the count.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, CharType, DataType, MapType, StringType, StructType, VarcharType

from ..session import work_dir
from ..sources.tables import written

POSITION = "_pos"
COPIES = "_copies"
#: Parts that the rows of a repeated key are dealt to where their positions are of variable width.
PARTS = 16
#: Columns of a key that is shuffled as it is where surplus rows are counted.
NARROW = 2


def collapse_exact(df: DataFrame, position: str = POSITION) -> DataFrame:
    """One row per distinct row (NULL equals NULL), at its first position, with the number of copies."""
    keys = [c for c in df.columns if c != position]
    return df.groupBy(*keys).agg(F.min(position).alias(position), F.count(F.lit(1)).alias(COPIES))


def fixed_width(kind: DataType) -> bool:
    """Whether the smallest of such values can be kept in place while rows are aggregated by hash."""
    return not isinstance(kind, (StringType, CharType, VarcharType, BinaryType, ArrayType, MapType, StructType))


def keep_first(df: DataFrame, keys: list[str], position: str = POSITION) -> DataFrame:
    """The first row of each key in ingest order, with the number of rows the key had; NULL keys are equal.

    Positions are unique. The frame is read once for the keys that occur more than once, which are written, and once for the
    rows; rows of other keys never meet.
    """
    repeats = written(_repeats(df, keys, position), work_dir(df.sparkSession, "repeats"))
    rest = [c for c in df.columns if c not in keys]
    rows = df.join(repeats, _same(keys), "left").where(F.col("_first").isNull() | (F.col(position) == F.col("_first")))
    return rows.select(*keys, *rest, F.coalesce(COPIES, F.lit(1)).cast("long").alias(COPIES))


def _same(keys: list[str]):
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])


def _repeats(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """(_key_0, ..., _first, COPIES) of the keys that more than one row has."""
    named = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    names = [f"_key_{i}" for i in range(len(keys))]
    count = F.count(F.lit(1)).alias(COPIES)
    if fixed_width(df.schema[position].dataType):
        return df.groupBy(*named).agg(F.min(position).alias("_first"), count).where(F.col(COPIES) > 1)
    # of a key's rows, the first of each part is found before the first of all
    several = df.groupBy(*named).agg(count).where(F.col(COPIES) > 1)
    rows = df.select(*keys, position).join(several, _same(keys)).select(*names, COPIES, F.col(position).alias("_first"))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_first"), F.lit(PARTS)))
    for by in ([*names, "_part"], names):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("_first"))
        rows = rows.withColumn("_place", place).where("_place = 1")
    return rows.select(*names, "_first", COPIES)


def surplus_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row, one column ``n``: rows beyond the first of each key. Of wide keys only digests are shuffled, and the keys
    of the rows whose digest comes more than once."""
    if len(keys) > NARROW:
        digest = F.xxhash64(*keys)
        several = df.groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_digest")
        several = written(several, work_dir(df.sparkSession, "repeated-digests"))
        df = df.join(several, digest == F.col("_digest"), "left_semi")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("n")
    )
