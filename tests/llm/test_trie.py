"""The trie of conversations, against one that holds every prefix as a tuple."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_shared import CLASHES

from funnelworks.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, code, len(text.encode()), (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        base = c - int(np.fmod(c, 5))
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns if base == c else own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        weight = len(p[-1][1].encode()) if p else 0
        saved[p] = sum(saved[k] for k in children[p]) + (len(members[p]) - 1) * weight
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
         sha(",".join(str(c) for c in m if len(built[c]) == len(p))))
        for p, m in members.items()
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("extra") for c in [*CLASHES, "id", "path", "base", "depth", "n"]})


def found(spark, given, **how):
    out = trie.prefix_trie(trie.rebuilt(frame(spark, given)), **how)
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    return sorted((tuple(r) for r in out.collect()), key=key)


def family(seed, conversations=120, most=14):
    """Few different turns, so that prefixes of all depths are shared, and whole conversations too."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(400, conversations, replace=False) - 60:
        for turn in range(int(rng.integers(1, most))):
            rows.append((int(c), turn, ["user", "assistant"][turn % 2], ["yes", "no", "é"][int(rng.choice(3, p=[0.8, 0.15, 0.05]))]))
    return [rows[i] for i in rng.permutation(len(rows))]


ordered = lambda rows: sorted(rows, key=lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r))


@pytest.mark.parametrize("rows,size", [(1, 10**9), (60, 10**9), (50_000, 1500), (50_000, 10**9)])
def test_all_prefixes(spark, rows, size):
    given = family(1)
    want = ordered(brute(given))
    assert found(spark, given, rows=rows, size=size) == want
    assert sum(r[3] > 1 for r in want) > 20 and max(r[1] for r in want) > 8


def test_odd_rows(spark):
    rows = family(2, 30, 5)
    rows += [(None, 1, "user", "lost"), (None, None, None, None), (700, None, "user", "first"), (700, -3, None, "second"), (700, 0, "user", None)]
    rows += [(701, 1, "user", "tie"), (701, 1, "assistant", "tie"), (701, 1, "user", "tie"), (702, 1, "user", ""), (702, 2, "", "user")]
    rows += [(703, t, "us", "er" + "x" * 50_000) for t in range(3)] + [(704, t, "user", "x" * 50_000) for t in range(3)]
    rows += [(-7, 0, "user", "negative"), (-5, 0, "user", "yes"), (2**62, 0, "user", "yes"), (9, 0, "user", "a short one on an absent base")]
    assert found(spark, rows) == ordered(brute(rows))
    assert found(spark, rows, rows=1) == ordered(brute(rows))


def test_conversations_without_turns_of_their_own_end_at_the_root(spark):
    short = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:40]
    rows = [(c, 0, "user", "gone") for c in short]
    got = found(spark, rows)
    assert got == [(short[0], 0, None, 40, 0, 1, 0, sha(",".join(map(str, sorted(short)))))]


def test_no_conversation(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []


def test_long_copies_and_a_hot_prefix(spark):
    """Two conversations of many equal turns are one block; a third of all conversations are equal."""
    rows = [(c, t, "user", f"turn {t % 7}") for c in (0, 5) for t in range(700)]
    rows += [(5 * c, 0, "user", "hot" if c % 3 == 0 else f"other {c % 50}") for c in range(10, 400)]
    want = ordered(brute(rows))
    assert found(spark, rows) == want
    assert found(spark, rows, rows=300) == want


def test_digests_of_ends_from_many_parts(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.expr("'k' || id % 400")).cast("binary").alias("id"), F.col("id").alias("conv_id"))
    want = defaultdict(list)
    for i in range(3000):
        want["hot" if i % 3 == 0 else f"k{i % 400}"].append(i)
    got = {bytes(r.id).decode(): r.sha for r in trie.digests_of_ends(df, chunk=7).collect()}
    assert got == {k: sha(",".join(map(str, v))) for k, v in want.items()}


def test_blocks_cover_every_depth_once():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lengths = {int(d): int(n) for d, n in zip(rng.integers(0, 60, 8), rng.integers(1, 500, 8))}
        plan = trie.blocks(lengths, rows=int(rng.integers(1, 3000)), size=int(rng.integers(20, 100_000)))
        depths = [d for low, high in plan for d in range(high, low - 1, -1)]
        assert depths == list(range(max(lengths), -1, -1))
    assert trie.blocks({}) == [] and trie.blocks({0: 5}) == [(0, 0)]
    plan = trie.blocks({3: 100, 4000: 2}, rows=10_000)
    assert plan[0] == (4, 4000) or plan[0][0] <= 4 and len(plan) == 1


def test_levels_are_aggregated_before_they_are_shuffled(spark):
    items = spark.createDataFrame([], "path binary, conv long, n long, children long, leaves long, saved long, ended long, ender long")
    plan = trie.one_level(items, 3)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan and "MapInArrow" not in plan
