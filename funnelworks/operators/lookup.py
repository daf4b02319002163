"""Label-to-id matching against small reference tables.

Labels are few and uneven, so rows must not be shuffled by them. The maps are broadcast when the reference tables they
come from are within spark.sql.autoBroadcastJoinThreshold; beyond it they are joined by shuffle, where adaptive
execution splits the frequent labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import norm


def small(df: DataFrame) -> bool:
    """True when the optimizer's size estimate is within the limit for broadcasts.

    Used where Spark cannot see on its own that a result is bounded: one row per member of a reference table. A client
    without access to the estimate gives no hint and leaves the choice to Spark.
    """
    if not hasattr(df, "_jdf"):
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def one_per_member(result: DataFrame, *references: DataFrame) -> DataFrame:
    """Marks a result with at most one row per reference member for broadcast, if the reference tables are small."""
    return F.broadcast(result) if all(small(r) for r in references) else result


def label_map(reference: DataFrame, name: str, ident: str, synonyms: DataFrame | None = None) -> DataFrame:
    """(_key, _id), one row per normalised label. Synonyms (label, name) win over reference names."""
    pairs = reference.select(norm(name).alias("_key"), F.col(ident).alias("_id"), F.lit(0).alias("_rank"))
    if synonyms is not None:
        target = reference.select(norm(name).alias("_target"), F.col(ident).alias("_id"))
        pairs = pairs.unionByName(
            synonyms.select(norm("label").alias("_key"), norm("name").alias("_target"))
            .join(target, "_target")
            .select("_key", "_id", F.lit(1).alias("_rank"))
        )
    best = pairs.groupBy("_key").agg(F.max_by("_id", F.struct("_rank", "_id")).alias("_id"))
    return one_per_member(best, *[t for t in (reference, synonyms) if t is not None])


def map_label(df: DataFrame, label: str, mapping: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: the id of the label, NULL when the label is unknown or missing."""
    m = mapping.select(F.col("_key").alias(f"_k_{out}"), F.col("_id").alias(out))
    return df.withColumn("_norm", norm(label)).join(m, F.col("_norm") == F.col(f"_k_{out}"), "left").drop(
        "_norm", f"_k_{out}"
    )


def mark_listed(df: DataFrame, value: str, listed: DataFrame, name: str, out: str) -> DataFrame:
    """Adds boolean ``out``: the value is, character for character, one of ``listed[name]``; false for NULL."""
    known = listed.select(F.col(name).alias(f"_l_{out}")).where(F.col(name).isNotNull()).distinct()
    known = one_per_member(known, listed)
    return (
        df.join(known, F.col(value) == F.col(f"_l_{out}"), "left")
        .withColumn(out, F.col(f"_l_{out}").isNotNull())
        .drop(f"_l_{out}")
    )
