"""Compression of vectors, against a direct evaluation that compares every part with every entry."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_shared import CLASHES, SMALL

from funnelworks.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries=codes.ENTRIES, rounds=codes.ROUNDS):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    longest = max(len(r[1]) for r in kept)
    width = max(-(-longest // 16), 1)
    most = codes.limit(16 * width)

    def whole(v):
        out = [min(max(math.floor(256 * float(np.float32(x))), -most), most) for x in v]
        return tuple(out + [0] * (16 * width - len(out)))

    kept = [(r[0], whole(r[1]), r[2]) for r in kept]
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1])[p] for r in first] for p in range(16)]
    for number in range(rounds + 1):
        found = [[min((far(x, e), i) for i, e in enumerate(books[p])) for p, x in enumerate(cut(r[1]))] for r in kept]
        if number == rounds:
            break
        for p in range(16):
            for i in range(len(books[p])):
                mine = [cut(r[1])[p] for r, f in zip(kept, found) if f[p][1] == i]
                if mine:
                    books[p][i] = tuple(sum(c) // len(mine) for c in zip(*mine))
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for r, e in zip(kept, errors):
        total[r[2]] = total.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{i:02x}" for _, i in f), e, total[r[2]], digest) for r, f, e in zip(kept, found, errors)]


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("extra") for c in [*CLASHES, "vector", "codes", "errors", "of"]})
    out, _ = codes.compress(df, **how)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()), key=repr)


def coarse(n, width, seed, step=4):
    """Vectors of few distinct values, so that ties and entries that stay are common."""
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) / 256 for x in rng.integers(-step, step, width)], int(rng.integers(0, 3))) for i in rng.permutation(n)]


@pytest.mark.parametrize("seed,width,entries", [(0, 32, 64), (1, 16, 8), (2, 48, 5)])
def test_against_all_entries(spark, seed, width, entries):
    rows = coarse(150, width, seed)
    assert found(spark, rows, entries=entries) == sorted(brute(rows, entries), key=repr)


def test_odd_rows(spark):
    rows = coarse(70, 20, 3)
    rows += [rows[0], rows[0], (None, [0.5] * 20, None), (None, [0.25] * 20, None), (500, None, 1), (501, [None] + [0.0] * 19, 1)]
    rows += [(502, [math.nan] + [0.0] * 19, 1), (503, [math.inf] + [0.0] * 19, 1), (504, [-math.inf] * 20, None), (505, [], 2)]
    rows += [(506, [1.0, 2.0], 2), (507, [3e38] * 20, 7), (508, [-3e38] * 20, 7), (-5, [1e-40] * 20, None)]
    want = brute(rows)
    assert found(spark, rows) == sorted(want, key=repr)
    assert {r[0] for r in want}.isdisjoint({500, 501, 502, 503, 504}) and {505, 506, 507, 508, None} <= {r[0] for r in want}


def test_nothing_usable(spark):
    for rows in ([], [(1, None, 1), (2, [math.nan], None)]):
        assert found(spark, rows) == []


def test_few_vectors_and_a_hot_label(spark):
    rows = [(i, [i / 100] * 16, 9 if i % 3 else None) for i in range(40)]
    assert found(spark, rows) == sorted(brute(rows), key=repr)


def test_active_entries_alone_decide_as_all_do():
    """Entries that move, stay or swap places, with many ties: the short comparison equals the long one."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        parts = rng.integers(-3, 4, (60, 4, 2))
        books = rng.integers(-3, 4, (4, 9, 2))
        active = np.ones((4, 9), bool)
        have = codes.assign(parts, books, active)
        for _ in range(4):
            moved = rng.random((4, 9)) < rng.choice([0, 0.2, 0.6, 1])
            new = np.where(moved[:, :, None], rng.integers(-3, 4, books.shape), books)
            active = (new != books).any(2)
            books = new
            have = codes.assign(parts, books, active, *have)
            want = codes.assign(parts, books, active)
            assert np.array_equal(have[0], want[0]) and np.array_equal(have[1], want[1])


def test_only_active_entries_are_compared(monkeypatch):
    asked = []
    plain = codes.nearest
    monkeypatch.setattr(codes, "nearest", lambda part, book, among: asked.append((len(part), list(among))) or plain(part, book, among))
    parts = np.array([[[0]], [[10]], [[20]]])
    books = np.array([[[0], [10], [20]]])
    have = codes.assign(parts, books, np.ones((1, 3), bool))
    books = np.array([[[0], [10], [17]]])
    codes.assign(parts, books, np.array([[False, False, True]]), *have)
    assert asked == [(3, [0, 1, 2]), (2, [2]), (1, [0, 1, 2])]


def test_codebooks_are_those_of_the_digest(spark):
    out, books = codes.compress(spark.read.parquet(f"{SMALL}/embeddings.parquet"))
    assert books.shape == (16, 64, 4) and out.first().codebooks_sha256 == codes.digest(books)
    assert out.count() == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
