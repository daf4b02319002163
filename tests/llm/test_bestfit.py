"""Best-fit packing: whole texts by the public library, and the search against brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests_llm_shared import CLASHES, corpus, nothing  # noqa: F401 - fixtures
from tokenizers import Tokenizer

from funnelworks.llm import bestfit

PATH = public_tokenizers.path("byte_bpe_50k.json")


def packed(df, **how):
    return bestfit.pack(df, PATH, public_tokenizers.PATTERN, **how).collect()


def check_layout(rows, size):
    """Sequences are gapless from 0 and hold no more than `size` tokens; returns how many there are."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(held)


def expected(library, texts, size, end=2):
    """(piece, start, length, checksum) of every piece of every text."""
    for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False):
        ids = np.array([*e.ids, end], "<u4")
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
        yield [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


@pytest.mark.parametrize("size,group", [(1024, 20_000), (100, 20_000), (128, 40)])
def test_pieces_and_layout(spark, corpus, nothing, size, group):
    rows, df = corpus
    df = df.withColumns({c: F.lit("extra") for c in [*CLASHES, "number", "group", "piece", "length"]})
    got = packed(df, size=size, group=group)
    want = expected(Tokenizer.from_file(PATH), [t for _, t in rows], size)
    every = sorted(((d, *p) for (d, _), parts in zip(rows, want) for p in parts), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == every
    number = check_layout(got, size)
    least = -(-sum(p[3] for p in every) // size)
    assert least <= number <= least * 1.02 + 2
    assert packed(nothing) == []


def test_many_groups_and_levels(spark):
    """Copies of one row and of one length in groups far smaller than the table."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.expr("repeat('word ', cast(1 + id * 7919 % 90 as int))")).otherwise("the same text").alias("text"),
    )
    got = packed(df, size=64, group=100)
    assert len(got) >= 4000 and {r.doc_id for r in got if r.doc_id is not None} == {i for i in range(4000) if i % 3}
    number = check_layout(got, 64)
    least = -(-sum(r.length for r in got) // 64)
    assert number <= 1.01 * least + 2


def fills(bins, lengths):
    return sorted(sum(lengths[i] for i in b) for b in bins)


def valid(bins, lengths, size):
    return sorted(i for b in bins for i in b) == list(range(len(lengths))) and max(fills(bins, lengths), default=0) <= size


def fewest(lengths, size):
    """Smallest number of bins, by trying every first bin."""
    items = tuple(sorted(lengths, reverse=True))

    @lru_cache(maxsize=None)
    def go(left):
        if not left:
            return 0
        best = len(left)
        rest = left[1:]
        for mask in range(1 << len(rest)):
            chosen = [rest[i] for i in range(len(rest)) if mask >> i & 1]
            if left[0] + sum(chosen) <= size:
                best = min(best, 1 + go(tuple(rest[i] for i in range(len(rest)) if not mask >> i & 1)))
        return best

    return go(items)


def test_near_the_fewest_bins():
    rng = np.random.default_rng(0)
    more = 0
    for _ in range(60):
        lengths = [int(x) for x in rng.integers(1, 21, rng.integers(1, 10))]
        bins = bestfit.pack_group(lengths, 20)
        assert valid(bins, lengths, 20)
        more += len(bins) - fewest(lengths, 20)
    assert more <= 1


@pytest.mark.parametrize("low,high,n", [(200, 700, 3000), (100, 400, 3000), (1, 1024, 3000), (300, 500, 1500), (600, 601, 500)])
def test_search_empties_bins(low, high, n):
    rng = np.random.default_rng(low)
    lengths = [int(x) for x in rng.integers(low, high, n)]
    first = bestfit.best_fit(lengths, 1024)
    after = bestfit.improve(first, lengths, 1024)
    assert valid(first, lengths, 1024) and valid(after, lengths, 1024)
    assert len(after) <= len(first)
    if len(after) < len(first):
        square = lambda bins: sum(f * f for f in fills(bins, lengths))
        assert square(after) > square(first)
    if (low, high) in ((200, 700), (100, 400)):
        assert len(first) - len(after) > 0.7 * (len(first) - -(-sum(lengths) // 1024))


def test_each_kind_of_step():
    # a move; one for one; one for two; two for one: the first bin is emptied by this alone
    for lengths, bins, size in (
        ([2, 5, 5], [[0], [1], [2]], 7),
        ([6, 4, 9, 1, 5, 5], [[0], [1, 4], [2, 3], [5]], 10),
        ([6, 2, 2, 5, 5, 4], [[0], [1, 2, 3], [4, 5]], 9),
        ([3, 3, 5, 4, 4], [[0, 1], [2, 3], [4]], 10),
    ):
        after = bestfit.improve(bins, lengths, size)
        assert valid(after, lengths, size) and len(after) <= len(bins)
        assert sum(f * f for f in fills(after, lengths)) >= sum(f * f for f in fills(bins, lengths))
    assert len(bestfit.improve([[0], [1], [2]], [2, 5, 5], 7)) == 2


def test_best_slot_is_the_fullest_bin():
    rng = np.random.default_rng(2)
    for _ in range(200):
        size = 30
        bins = {}
        for b in range(6):
            items = []
            while sum(items) + (x := int(rng.integers(1, 15))) < size and len(items) < 4:
                items.append(x)
            bins[b] = items
        for pairs in (False, True):
            slots = bestfit.Slots(size)
            for b, items in bins.items():
                slots.add(b, items, pairs)
            for b in (1, 4):
                slots.remove(b, bins[b], pairs)
            n = int(rng.integers(1, size))
            options = [(room - n, -left) for b in (0, 2, 3, 5) for room, left, out in slots.of(bins[b], size, pairs) if room >= n > sum(out)]
            got = slots.find(n)
            assert (got is None) == (not options)
            if got:
                spare, b, out = got
                assert spare == min(options)[0] and size - sum(bins[b]) + sum(out) - n == spare and n > sum(out)
