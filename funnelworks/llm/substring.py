"""Substring deduplication by seed and extend: winnowed anchors meet, matches are extended, long repeats are cut.

A window is `window` consecutive words. Its anchor is the smallest hash among its runs of `seed` words, the last one of equal
hashes; so equal windows have equal anchors, and windows without a common anchor need no comparison. Neighbouring windows
of one anchor form a block: the anchor extended both ways as far as it stays the anchor. The work goes from coarse to fine:

1. Anchors of only one document are dropped (about one row per twenty words was made).
2. Blocks of equal content are matched as a whole: inside a long repeat all blocks are equal in all its copies.
3. Where one anchor stands in different blocks, as at the edges of a repeat, the windows of one copy of each such block are
   matched one by one.

Every step is an aggregation to the smallest doc_id and a join back, so a passage that a third of all documents share is
reduced before it is shuffled, and its join is one that Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import sieve, sifted
from .shared import CACHED_BYTES, LAST, mixed, over_batches, run_hashes, slices, stored, text_bytes, word_bounds, word_hashes

WINDOW, SEED = 50, 12
_SECOND = np.uint64(0xD1B54A32D192ED03)


def last_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values, the place of its smallest one, the last of equals."""
    best, place, size = values, np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        right = best[step:] <= best[:-step]
        place = np.where(right, place[step:], place[:-step])
        best = np.minimum(best[step:], best[:-step])
        size += step
    return place


def blocks(raw: np.ndarray, offsets: np.ndarray, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Text, first window and number of windows, anchor hash and content hash of every block."""
    starts, ends, first = word_bounds(raw, offsets)
    n = len(starts)
    if n < window:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = word_hashes(raw, starts, ends)
    at = np.arange(n - seed + 1)
    seeds = run_hashes(hashes, at, at + seed)
    chosen = last_minimum(seeds, window - seed + 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    begin = np.arange(len(chosen))
    whole = owner[begin] == owner[begin + window - 1]  # windows within one text
    begin, chosen = begin[whole], chosen[whole]
    if not len(begin):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    new = np.ones(len(begin), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[begin[1:]] != owner[begin[:-1]])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(begin)))
    start = begin[head]
    text = owner[start]
    return text, start - first[text], count, seeds[chosen[head]], run_hashes(hashes, start, start + count - 1 + window)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def all_blocks(rows: DataFrame, window: int, seed: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CACHED_BYTES):
                text, start, count, anchor, content = blocks(*text_bytes(part.column("text")), window, seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(text)), part.column("row_key").take(pa.array(text)),
                        pa.array((start << 32) | count), _signed(anchor), _signed(content),
                    ],
                    names=["doc", "row_key", "range", "anchor", "content"],
                )

    return over_batches(rows, work, "doc long, row_key long, range long, anchor long, content long")


def windows(rows: DataFrame, window: int) -> DataFrame:
    """Two hashes of every window in the `ranges` of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                starts, ends, first = word_bounds(*(bytes_ := text_bytes(part.column("text"))))
                hashes = word_hashes(bytes_[0], starts, ends)
                ranges = part.column("ranges")
                size = np.diff(ranges.offsets.to_numpy())
                flat = ranges.flatten().to_numpy()
                owner = np.repeat(np.arange(part.num_rows), size)
                start, count = flat >> 32, flat & 0xFFFFFFFF
                inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                owner, start = np.repeat(owner, count), np.repeat(start, count) + inner
                at = start + first[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(owner)), part.column("row_key").take(pa.array(owner)),
                        pa.array((start << 32) | 1), _signed(run_hashes(hashes, at, at + window)),
                        _signed(run_hashes(mixed(hashes + _SECOND), at, at + window)),
                    ],
                    names=["doc", "row_key", "range", "one", "two"],
                )

    return over_batches(rows, work, "doc long, row_key long, range long, one long, two long")


def repeats(documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Every row with its words' ranges that repeat a window of a document with a smaller doc_id: doc_id, text and ranges
    (first window * 2**32 + number of windows)."""
    rows = documents.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("row_key")
    )
    made = stored(all_blocks(rows.select("doc", "row_key", "text"), window, seed), "blocks")
    # what is joined back is written first: a join in the task of an aggregation could not split a frequent key
    both = made.groupBy("anchor").agg(F.min("doc").alias("lowest"), F.max("doc").alias("highest")).where("lowest < highest")
    both = stored(both.select("anchor"), "shared-anchors")
    shared = stored(sifted(made, "anchor", sieve(both, "anchor")).join(both, "anchor"), "shared-blocks")
    equal = stored(shared.groupBy("anchor", "content").agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "equal-blocks")
    copies = shared.join(equal.where("first < last").drop("last"), ["anchor", "content"]).where("first < doc")

    several = stored(equal.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors-of-several-blocks")
    edges = shared.join(equal.drop("last").join(several, "anchor"), ["anchor", "content"]).where("first = doc")
    wanted = edges.groupBy("doc", "row_key").agg(F.collect_list("range").alias("ranges"))
    single = stored(windows(rows.select("doc", "row_key", "text").join(wanted, ["doc", "row_key"]), window), "windows")
    again = single.groupBy("one", "two").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    again = stored(again.drop("last"), "equal-windows")
    late = single.join(again, ["one", "two"]).where("first < doc")

    cut = copies.select("doc", "row_key", "range").unionByName(late.select("doc", "row_key", "range"))
    ranges = cut.groupBy("doc", "row_key").agg(F.collect_list("range").alias("ranges"))
    return rows.join(ranges, ["doc", "row_key"], "left").select("doc_id", "text", "ranges")


def cut_words(text: bytes, ranges: np.ndarray, window: int) -> tuple[list[bytes], int]:
    """Words that stay, and the number of all words."""
    words = text.split()
    if not len(ranges):
        return words, len(words)
    edge = np.zeros(len(words) + 1, np.int64)
    start, count = ranges >> 32, ranges & 0xFFFFFFFF
    np.add.at(edge, start, 1)
    np.add.at(edge, start + count - 1 + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~gone)], len(words)


def remove_repeats(documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and kept, the words that stay joined by one space.

    Removed is each word that a window covers whose words also stand together in a document with a smaller doc_id. Windows
    are those of the input, not of what is left. A missing text has no words; a missing doc_id counts as the largest; rows
    of one doc_id do not remove from each other. Other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                raw, offsets = text_bytes(part.column("text"))
                data = raw.tobytes()
                out = []
                for i, ranges in enumerate(part.column("ranges")):
                    stay, n = cut_words(
                        data[offsets[i] : offsets[i + 1]], ranges.values.to_numpy() if ranges.is_valid else none, window
                    )
                    kept = b" ".join(stay)
                    out.append((n, n - len(stay), hashlib.sha256(kept).hexdigest(), kept.decode()))
                n, removed, digest, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return over_batches(
        repeats(documents, window, seed), work, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     v AS (SELECT r, doc, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
           FROM (SELECT r, doc, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
     m AS (SELECT h, min(doc) AS first FROM v GROUP BY h HAVING min(doc) < max(doc)),
     g AS (SELECT DISTINCT r, i + k AS p FROM v JOIN m USING (h), range(0, 50) AS t(k) WHERE first < doc),
     k AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n
           FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d) ANTI JOIN g USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
