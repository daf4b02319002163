"""Exact deduplication by a tree of merged digest runs, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Rows of a first run and of a range of digests, which the last round merges in one task (about, at most), and the fewest
#: runs that rows are dealt to.
RUN_ROWS, RANGE_ROWS, LEAST_RUNS = 1 << 20, 1 << 15, 16
_WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; a missing text is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in _WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def runs_for(rows: int) -> int:
    """A power of two, so that rounds of pairs end with one run."""
    return max(LEAST_RUNS, 1 << max(rows // RUN_ROWS, 1).bit_length())


def merged(runs: DataFrame, fan_in: int) -> DataFrame:
    """One round: of each `fan_in` neighbouring runs, the others go to the first, and all are merged by one pass over their
    rows in order of digest. Of each digest, the best candidate stays and the members add up. Runs of one range of digests
    meet in one task, those of different ranges do not."""
    together = runs.withColumn("run", F.expr(f"run div {fan_in}").cast("int"))
    sorted_runs = together.repartition("range", "run").sortWithinPartitions("range", "run", "digest", "bytes")
    return sorted_runs.groupBy("range", "run", "digest", "bytes").agg(F.min("best").alias("best"), F.sum("members").alias("members"))


def keep_one(documents: DataFrame, runs: int | None = None, fan_in: int = 2) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept and text_sha256.

    Every row gets the digest of its normalised text, the range that the digest lies in, and a run; the number of ranges and of
    runs follow from the number of rows. Within a run, rows of equal digest are reduced to the best candidate, the one with
    the most code points, then the smallest doc_id. Then the runs of a range are exchanged and merged in rounds, in each of
    which run 2i + 1 goes to run 2i (or `fan_in` runs to the first of them), until every range has one run. Digests only meet if the
    normalised texts are of equal length too. The verdict goes back to the first runs, and from these to their rows: a
    text that a third of all rows share is dealt to all runs on the way up and down.

    Missing and empty texts are one group. A missing doc_id counts as the largest; of repeated rows, one stays. Other
    columns are ignored.
    """
    clean = documents.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"), normalised(F.col("text")).alias("clean"))
    rows = clean.select(
        "doc_id", "chars", F.sha2("clean", 256).alias("digest"), F.octet_length("clean").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "digests")
    number = rows.count()
    left = runs_for(number) if runs is None else runs
    ranges = max(number // RANGE_ROWS, 1)
    lead = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    rows = rows.withColumns({
        "run": F.pmod(F.xxhash64("row"), F.lit(left)).cast("int"),
        "range": F.floor(lead * ranges / 2**32).cast("int"),
    })
    rank = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    key = ["range", "run", "digest", "bytes"]
    first = stored(rows.groupBy(*key).agg(F.min(rank).alias("best"), F.count("*").alias("members")), "runs")
    verdict = first
    while left > 1:
        verdict = stored(merged(verdict, fan_in), "merge-round")
        left = -(-left // fan_in)
    verdict = verdict.select("digest", "bytes", F.col("best").alias("stays"), F.col("members").alias("group_size"))
    back = stored(first.drop("best", "members").join(verdict, ["digest", "bytes"]), "verdicts")
    found = rows.select("doc_id", "row", *key).join(back, key)
    return found.select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
     r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size
           FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""
