"""Star tables on storage: write, audit, publish - and reading back only what was published."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Star, month_of
from ..schemas import MONTH, PLACED_BY, STAR_SCHEMAS, ddl
from ..session import together

MARKER = "_published"


def written(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """The frame, written as Parquet and read back: cuts the lineage at durable storage. ``by`` names the column whose
    values get folders of their own."""
    if by is None:
        df.write.mode("errorifexists").parquet(path)
    else:
        df.hint("rebalance", by).write.mode("errorifexists").partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_star(star: Star, folder: str, step: Callable[[str, Callable[[str], None]], object] | None = None) -> None:
    """One folder per table, facts partitioned by month; ``step`` decides for each table whether its write is due.

    The rebalance hint brings the rows of a month together before the write and lets adaptive execution merge small
    months and split a month that holds too much, so files have a sensible size at any volume.
    """

    def write(name: str, path: str) -> None:
        df = star[name].select(*STAR_SCHEMAS[name])
        if name in PLACED_BY:
            df = df.withColumn(MONTH, month_of(F.expr(PLACED_BY[name]))).hint("rebalance", MONTH)
            df.write.mode("errorifexists").partitionBy(MONTH).parquet(path)
        else:
            df.write.mode("errorifexists").parquet(path)

    step = step or (lambda name, work: work(f"{folder}/{name}"))
    together([partial(step, name, partial(write, name)) for name in STAR_SCHEMAS])


def read_star(spark: SparkSession, folder: str, period: tuple[int, int]) -> Star:
    """The star written to the folder. The schema is declared, so nothing is scanned to find it out."""

    def load(name: str) -> DataFrame:
        extra = {MONTH: "int"} if name in PLACED_BY else {}
        return spark.read.schema(ddl({**STAR_SCHEMAS[name], **extra})).parquet(f"{folder}/{name}")

    plain = {name: (lambda name=name: load(name).drop(MONTH)) for name in STAR_SCHEMAS}
    return Star(plain, period, {name: partial(load, name) for name in PLACED_BY})


def mark_published(spark: SparkSession, folder: str, period: tuple[int, int]) -> None:
    """The marker is written beside its place and then renamed, so that it is there as a whole or not at all."""
    beside = f"{folder}/.{uuid.uuid4().hex}"
    spark.range(1).select(F.lit(period[0]).alias("first"), F.lit(period[1]).alias("last")).write.json(beside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(f"{folder}/{MARKER}"), True)
    if not files.rename(path(beside), path(f"{folder}/{MARKER}")):
        raise OSError(f"could not publish {folder}")


def read_published(spark: SparkSession, folder: str) -> Star:
    """The star of a finished build. A build that failed its audit has no marker, and reading it fails here."""
    row = spark.read.schema("first int, last int").json(f"{folder}/{MARKER}").first()
    return read_star(spark, folder, (row["first"], row["last"]))
