"""Benchmark decontamination: test items that long documents contain, with DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANK, stored

SHINGLE, CONTAINMENT = 5, 0.8
#: Signature rows that are sent to all executors at a time (16 bytes each); more are sent in several passes.
BROADCAST_ROWS = 500_000
_EDGES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of the lower-cased text; none for a missing or blank one."""
    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_EDGES))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, BLANK))


def shingles(column: str, size: int, of) -> Column:
    """`of` the words of each run of `size`, or of the whole sequence if it is shorter; none without words. Words are taken
    one by one: a slice would copy the whole text for every run. Both uses of `of` skip the missing words of short ones."""
    places = F.sequence(F.lit(0), F.greatest(F.size(column) - size, F.lit(0)))
    found = F.transform(places, lambda i: of(*[F.get(F.col(column), i + k) for k in range(size)]))
    return F.when(F.size(column) > 0, found)


def joined(*run: Column) -> Column:
    return F.concat_ws(" ", *run)


def _hits(tokens: DataFrame, signature: DataFrame, size: int, run: Column) -> DataFrame:
    """Documents that have a value of a signature among the hashes of their runs of `size` words. A row per run, hashed and
    probed in one generated loop; the signatures are on all executors."""
    places = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))
    probes = tokens.select("doc_id", "row_key", "words", F.explode(places).alias("i"))
    probes = probes.select("doc_id", "row_key", F.xxhash64(*[F.get("words", F.col("i") + k) for k in range(size)]).alias("hash"))
    return probes.join(F.broadcast(signature.where(run).drop("run")), "hash").select("doc_id", "row_key", "item_id", "item_key")


def contained(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE,
    threshold: float = CONTAINMENT,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Pairs of a document and a test item of whose distinct shingles the document has at least `threshold`: doc_id,
    item_id, item_shingles, shared, containment, and row_key, which tells apart documents of one doc_id.

    Items are partitioned by the magnitude of their number of shingles. All items of a partition have a MinHash signature
    of the same length: their k smallest shingle hashes, where k is what the largest item may lack by the threshold, and
    one more. A document that contains an item therefore has at least one value of its signature, so none is missed,
    however long the document is. Documents are probed with the hashes of all their shingles; candidates are then
    compared by the shingles themselves. Signatures beyond `broadcast_rows` are probed in several passes over the
    documents, each with a part of them, so the shingles of the corpus are never shuffled.

    An item of fewer than `size` words is one shingle of its length, for which documents are probed with all runs of
    that length. Items or documents without words match nothing. Items are told apart by item_id and text; repeated rows count
    once. A missing doc_id or item_id stays missing.
    """
    items = benchmark.select("item_id", "text").distinct().select("item_id", words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).select(
        "item_id", F.xxhash64("words").alias("item_key"),
        F.array_distinct(shingles("words", size, joined)).alias("item_set"),
        F.array_sort(F.array_distinct(shingles("words", size, F.xxhash64))).alias("hashes"),
        F.least(F.size("words"), F.lit(size)).alias("run"),
    )
    items = stored(items.withColumn("item_shingles", F.size("item_set")), "benchmark")
    # the largest size of the partition, and how many shingles the largest item may lack
    top = F.pow(F.lit(2.0), F.floor(F.log2("item_shingles")) + 1) - 1
    length = (F.floor(top * (1 - threshold) + 1e-9) + 1).cast("int")
    signature = items.select("item_id", "item_key", "run", F.explode(F.slice("hashes", F.lit(1), length)).alias("hash"))
    signature = stored(signature, "signatures")
    numbers = {r["run"]: r["count"] for r in signature.groupBy("run").count().collect()}  # at most `size` rows

    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("row_key"))
    tokens = rows.select("doc_id", "row_key", words(F.col("text")).alias("words"))
    hits = []
    for run, number in sorted({size: 0, **numbers}.items()):
        passes = max(-(-number // broadcast_rows), 1)
        for k in range(passes):
            mine = (F.col("run") == run) & (F.pmod(F.xxhash64("hash", "item_key", "item_id"), F.lit(passes)) == k)
            hits.append(_hits(tokens, signature, run, mine))
    candidates = stored(reduce(DataFrame.unionByName, hits).distinct(), "candidates")

    full = candidates.alias("c").join(
        items.alias("i"), F.expr("c.item_key = i.item_key AND c.item_id <=> i.item_id")
    ).select("c.doc_id", "c.row_key", "c.item_id", "item_set", "item_shingles", "run")
    pairs = full.alias("f").join(rows.alias("d"), F.expr("f.row_key = d.row_key AND f.doc_id <=> d.doc_id"))
    pairs = pairs.select("f.doc_id", "f.row_key", "item_id", "item_set", "item_shingles", "run", words(F.col("text")).alias("words"))
    had = shingles("words", size, joined)
    for run in sorted(set(numbers) - {size}):
        had = F.when(F.col("run") == run, shingles("words", run, joined)).otherwise(had)
    # written before it is filtered: a filter on the count would be pushed below the words and split the text for every run
    shared = F.size(F.array_intersect("item_set", had)).alias("shared")
    checked = stored(pairs.select("doc_id", "row_key", "item_id", "item_shingles", shared), "compared").distinct()
    return checked.where(F.col("shared") >= F.col("item_shingles") * threshold - 1e-9).select(
        "doc_id", "item_id", "item_shingles", "shared", (F.col("shared") / F.col("item_shingles")).alias("containment"), "row_key"
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_split_to_array(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                                '[\x20\x09-\x0D]+') AS w FROM documents
           WHERE trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
     b AS (SELECT item_id, regexp_split_to_array(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                                 '[\x20\x09-\x0D]+') AS w FROM benchmark
           WHERE trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
     bs AS (SELECT DISTINCT item_id, least(len(w), 5) AS r, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
                                            lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM b),
     ds AS (SELECT DISTINCT doc_id, r, unnest(list_transform(range(1, len(w) - r + 2),
                                           lambda i: array_to_string(list_slice(w, i, i + r - 1), ' '))) AS s
            FROM d, (SELECT DISTINCT r FROM bs) WHERE len(w) >= r),
     n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id),
     m AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (s, r) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(item_shingles AS INTEGER) AS item_shingles, CAST(shared AS INTEGER) AS shared,
       shared / item_shingles AS containment
FROM m JOIN n USING (item_id) WHERE shared >= item_shingles * 0.8 - 1e-9
"""
