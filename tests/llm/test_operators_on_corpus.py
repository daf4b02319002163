"""Operators that compare rows with each other, against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_shared import Groups, corpus, links, nothing  # noqa: F401 - fixtures

from funnelworks.llm import decontaminate, exact, lines, linking, neardup, shared, substring

LAST = 2**63 - 1
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def ordered(rows):
    return sorted(rows, key=repr)


def test_exact_copies(spark, corpus, nothing):
    rows, df = corpus
    clean = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, c in enumerate(clean):
        groups.setdefault(c, []).append(i)
    want = []
    for c, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        digest = hashlib.sha256(c.encode()).hexdigest()
        want += [(rows[i][0], rows[best][0], len(members), digest) for i in members]
    got = exact.keep_one(df, runs=6, fan_in=3).collect()
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(want)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact.keep_one(nothing).count() == 0


def test_exact_copies_with_a_hot_text(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact.keep_one(df).where("text_sha256 = sha2('sametext', 256)").agg(F.count("*"), F.min("keep_id"), F.max("keep_id"), F.sum(F.col("kept").cast("int")), F.max("group_size")).first()
    assert tuple(got) == (1000, 0, 0, 1, 1000)


def brute_repeats(rows, window):
    first = {}
    split = [words(t) for _, t in rows]
    for (d, _), w in sorted(zip(rows, split), key=lambda x: LAST if x[0][0] is None else x[0][0]):
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), LAST if d is None else d)
    for (d, _), w in zip(rows, split):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (LAST if d is None else d):
                gone[i : i + window] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        yield d, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()


def test_long_repeats(spark, corpus, nothing):
    rows, df = corpus
    got = ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(df).collect())
    want = ordered(brute_repeats(rows, 50))
    assert got == want and sum(r[2] for r in want) > 30_000
    assert substring.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_long_repeats_of_few_words(spark, seed):
    """With three words and short windows, every kind of overlap occurs."""
    rng = np.random.default_rng(seed)
    rows = [(int(d), " ".join(rng.choice(["a", "b", "c"], rng.integers(0, 40)))) for d in rng.integers(0, 60, 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(df, window=8, seed=3).collect())
    assert got == ordered(brute_repeats(rows, 8))


def test_anchors_of_equal_windows_are_equal():
    values = np.random.default_rng(0).integers(0, 5, 300).astype(np.uint64)
    for width in (1, 2, 7, 39):
        want = [i + width - 1 - int(np.argmin(values[i : i + width][::-1])) for i in range(300 - width + 1)]
        assert substring.last_minimum(values, width).tolist() == want


def shingled(text, size):
    w = words((text or "").encode().translate(LOWER).decode())
    return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))) if w else frozenset()


@pytest.mark.parametrize("size", [2, 5])
def test_near_copies(spark, corpus, nothing, size):
    rows, df = corpus
    sets = [shingled(t, size) for _, t in rows]
    groups = Groups(range(len(rows)))
    for a, b in links(sets, 4, 5):
        groups.link(a, b)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        g = groups.of(i)
        smallest[g] = min(smallest.get(g, LAST), LAST if d is None else d)
    want = []
    for i, (d, _) in enumerate(rows):
        low = smallest[groups.of(i)]
        low = None if low == LAST else low
        want.append((d, len(sets[i]), low, d == low))
    got = neardup.groups(df, size).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == ordered(want)
    assert sum(r.stays for r in got) == len(smallest)
    assert neardup.groups(nothing, size).count() == 0


def test_chance_to_miss_a_link():
    missed = 1 - (1 - (1 - 0.8**neardup.ROWS) ** neardup.HALVES) ** 2
    assert missed < 1e-4
    assert (1 - 0.8**lines.ROWS) ** lines.BANDS < 2e-4


def test_links_across_components_of_a_bucket(spark):
    """b is like a and like c, a is not like c: all in one bucket, of which a is the smallest node."""
    base = [f"w{i}" for i in range(100)]
    edit = lambda k, n: [f"e{k}x{i}" if i < n else w for i, w in enumerate(base)]
    texts = {1: edit(0, 0), 2: edit(1, 8), 3: base[:-9] + [f"z{i}" for i in range(9)], 4: [f"other{i}" for i in range(100)]}
    texts[5] = texts[4][:-6] + ["new"] * 6
    rows = [(n, " ".join(w)) for n, w in texts.items()]
    nodes = spark.createDataFrame(rows, "node long, text string")
    keyed = spark.createDataFrame([(n, [7]) for n in texts], "node long, keys array<long>")
    got = linking.linked(keyed, lambda wanted: nodes.join(wanted, "node"), neardup.shingle_sets(1), (4, 5))
    assert {r.node: r.component for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


@pytest.mark.parametrize("packed", [False, True])
def test_met_in_buckets(spark, packed):
    """Keys do not become rows before they are found to be of several nodes; a large bucket is only named."""
    rng = np.random.default_rng(5)
    key = lambda n: rng.integers(-(2**63), 2**63, n)
    hot, common = int(key(1)[0]), key(60)
    have = {int(n): [int(k) for k in (*key(3), *rng.choice(common, 2))] for n in key(900)}
    for n in list(have)[:700]:
        have[n].append(hot)
    have[12345] = []
    rows = [(n, np.array(keys, np.int64).tobytes() if packed else keys) for n, keys in have.items()]
    df = spark.createDataFrame(rows + rows[:5], f"node long, keys {'binary' if packed else 'array<long>'}").repartition(3)
    nodes = {}
    for n, keys in have.items():
        for k in keys:
            nodes.setdefault(k, set()).add(n)
    want = {(None, min(m), n) for k, m in nodes.items() if k != hot for n in m if n != min(m)}
    found = linking.met_in_buckets(df, 6)
    assert {tuple(r) for r in found.collect()} == want | {(hot, min(nodes[hot]), max(nodes[hot]))}
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert linking.met_in_buckets(df.limit(0), 6).count() == 0


@pytest.mark.parametrize("large", [2, 10**6])
def test_large_buckets_are_linked_whole(spark, monkeypatch, large):
    monkeypatch.setattr(linking, "LARGE", large)
    base = [f"w{i}" for i in range(60)]
    texts = {n: " ".join(base[: -(n % 4) or None] + [f"own{n}"]) for n in range(1, 40)} | {50: "quite another text"}
    nodes = spark.createDataFrame(list(texts.items()), "node long, text string")
    keyed = spark.createDataFrame([(n, [2**61, 5 * n * 2**40]) for n in texts], "node long, keys array<long>").coalesce(1)
    got = linking.linked(keyed, lambda wanted: nodes.join(wanted, "node"), neardup.shingle_sets(1), (4, 5), 2)
    assert {r.node: r.component for r in got.collect()} == {n: 1 for n in range(1, 40)}


def test_sketches_pass_all_similar_sets():
    rng = np.random.default_rng(8)
    passed = total = 0
    for size in (1, 3, 30, 400, 3000):
        for _ in range(40):
            x = rng.integers(0, 2**64, size, dtype=np.uint64)
            y = np.where(rng.random(size) < rng.choice([0.05, 0.11, 0.5]), rng.integers(0, 2**64, size, dtype=np.uint64), x)
            parts = [np.concatenate([x, x[:2]]), y]
            may_be = linking.may_be_similar(np.array([len(s) for s in parts]), linking.sketched(parts), np.array([0]), np.array([1]), (4, 5))[0]
            assert may_be or not linking.similar(*map(shared.distinct, parts), (4, 5))
            total += not linking.similar(*map(shared.distinct, parts), (4, 5))
            passed += may_be and not linking.similar(*map(shared.distinct, parts), (4, 5))
    assert total > 50 and passed < total / 2


def test_plain_lines():
    blank = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"]
    assert sorted(lines.SPACES + lines.WIDE) == blank and lines.SPACES.isascii() and not any(c.isascii() for c in lines.WIDE)
    parts = ["", " ", "  ", "\n", "\n\n", "a", "B", "ΑΣ", "İ", "ß", "日本", "\t", "\r\n", "\u3000", "\xa0", "\x1d", "some words "]
    rng = np.random.default_rng(2)
    for _ in range(3000):
        text = "".join(rng.choice(parts[: rng.choice([11, 17])], rng.integers(0, 9)))
        assert lines.plain_lines(text) == [plain(line) for line in text.split("\n")]


@pytest.mark.parametrize("few", [0, 10**6])
def test_components_of_random_links(spark, monkeypatch, few):
    """The rounds and the single task find the same components."""
    monkeypatch.setattr(linking, "FEW_LINKS", few)
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-150, 150, (170, 2))] + [(400 + i, 401 + i) for i in range(30)]
    groups = Groups({x for p in pairs for x in p})
    for a, b in pairs:
        groups.link(a, b)
    got = {r.node: r.component for r in linking.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: groups.of(x) for x in linked}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 900)]
    df = spark.createDataFrame(chain + [(b, a) for a, b in star] + [(3, 3)], "a long, b long")
    got = {r.node: r.component for r in linking.components(df).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 7 for i in [7, *range(200, 900)])
    assert len(got) == 61 + 701


def test_sieve_lets_all_keys_pass(spark):
    keys = spark.range(-500, 500, 7).select((F.col("id") * 987654321987).alias("key"))
    every = spark.range(-500, 500).select((F.col("id") * 987654321987).alias("key"))
    left = linking.sifted(every, "key", linking.sieve(keys, "key"))
    assert keys.join(left, "key", "left_anti").count() == 0 and left.count() < 200


def plain(line):
    return " ".join(line.lower().split())


def test_fuzzy_lines(spark, corpus, nothing):
    rows, df = corpus
    distinct = sorted(set(rows), key=lambda r: (LAST if r[0] is None else r[0], ))
    every = [(r, i, p) for r in distinct for i, line in enumerate((r[1] or "").split("\n")) if len(p := plain(line)) >= lines.SHINGLE]
    texts = sorted({p for *_, p in every})
    sets = [frozenset(t[k : k + lines.SHINGLE] for k in range(len(t) - lines.SHINGLE + 1)) for t in texts]
    groups = Groups(range(len(texts)))
    for a, b in links(sets, *lines.SHARE):
        groups.link(a, b)
    place = {t: i for i, t in enumerate(texts)}
    lost, total = {}, {}
    for r, i, p in every:
        total.setdefault(groups.of(place[p]), []).append((r, i))
    got = lines.remove_lines(df, ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    by_row = {}
    for r in got:
        left = [] if r.kept_text is None else r.kept_text.split("\n")
        assert r.n_lines == len((r.text or "").split("\n")) * (r.text is not None)
        assert r.kept_sha256 == hashlib.sha256((r.kept_text or "").encode()).hexdigest()
        by_row[r.doc_id, r.text] = (r.n_removed, left)
    # of each component one line stays, that of the smallest doc_id where this is unique
    removed = sum(n for n, _ in by_row.values())
    assert removed == len(every) - len(total)
    for members in total.values():
        ids = [LAST if r[0] is None else r[0] for r, _ in members]
        first = members[0]
        if ids.count(ids[0]) == 1 and len(members) > 1:
            line = (first[0][1] or "").split("\n")[first[1]]
            assert line in by_row[first[0]][1]
    del lost
    assert lines.remove_lines(nothing).count() == 0


def test_fuzzy_lines_link(spark):
    line = "a rather long line that is written twice with one small change in it, so that most of it is equal"
    df = spark.createDataFrame([(2, f"{line}!\nsecond"), (1, f"first\n{line.upper()}"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: (r.kept_text, r.n_lines, r.n_removed) for r in lines.remove_lines(df, ["doc_id"]).collect()}
    assert got == {1: (f"first\n{line.upper()}", 2, 0), 2: ("second", 2, 1), 3: (None, 0, 0), 4: ("", 1, 0)}


def test_benchmark_items(spark, corpus, nothing):
    rows, df = corpus
    items = [(1, "shared0 shared1 shared2 shared3 shared4 shared5 shared6 shared7"), (2, "One"), (3, None), (4, " "), (5, "SHARED10 shared11 shared12 shared13 shared14 shared15 shared16 shared17 shared18 not"), (5, "other item of this id one two"), (None, "without an id a text without an id")]
    given = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(100 + i, t) for i, t in given] + items[:1]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("extra")).withColumn("hash", F.lit(1))
    found = decontaminate.contained(df, bench).collect()
    want = set()
    short = lambda t: min(len((t or "").split()), 5)
    docs = {(d, t): {k: frozenset() if short(t) < k else shingled(t, k) for k in range(1, 6)} for d, t in rows}
    for item, text in set(items):
        s = shingled(text, 5)
        for (d, t), runs in docs.items():
            have = runs[max(short(text), 1)]
            if s and len(s & have) >= 0.8 * len(s) - 1e-9:
                want.add((d, item, len(s), len(s & have)))
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in found} == want and len(want) > 5
    assert all(r.containment == r.shared / r.item_shingles for r in found)
    assert {(r.doc_id, r.item_id) for r in found} >= {(9003, 2), (9011, 2)}  # short items within longer documents
    passes = decontaminate.contained(df, bench, broadcast_rows=40).collect()
    assert sorted(map(str, passes)) == sorted(map(str, found))
    assert decontaminate.contained(nothing, bench).count() == 0
    assert decontaminate.contained(df, bench.limit(0)).count() == 0


def test_signatures_cannot_miss(spark):
    """Documents that have just enough of an item, for items of many sizes."""
    rng = np.random.default_rng(1)
    items, docs = [], []
    for i, n in enumerate(range(5, 60)):
        w = [f"i{i}w{k}" for k in range(n)]
        items.append((i, " ".join(w)))
        keep = int(np.ceil(0.8 * (n - 4))) + 4
        at = int(rng.integers(0, n - keep + 1))
        docs.append((i, " ".join(["before"] * 3 + w[at : at + keep] + ["after"] * 3)))
    found = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(i, i) for i in range(55)}


def test_short_items_are_found_wherever_they_stand(spark):
    text = "zero one two three four five six seven eight nine"
    docs = spark.createDataFrame([(1, text), (2, "three four"), (3, "four three"), (4, "")], "doc_id long, text string")
    items = [(k, " ".join(text.split()[3 : 3 + k])) for k in range(1, 6)] + [(9, "three five"), (10, " ")]
    found = decontaminate.contained(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, k) for k in range(1, 6)} | {(2, 1), (2, 2), (3, 1)}
    assert all(r.item_shingles == r.shared == 1 for r in found)


def test_many_signatures_never_shuffle_shingles(spark, tmp_path):
    docs = spark.range(30).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 30), i -> concat('w', id, 'x', i))) AS text")
    items = docs.where("doc_id % 3 = 0").selectExpr("doc_id AS item_id", "text")
    tokens = docs.select("doc_id", F.xxhash64("text").alias("row_key"), decontaminate.words(F.col("text")).alias("words"))
    signature = items.select("item_id", F.col("item_id").alias("item_key"), F.lit(5).alias("run"), F.xxhash64("text").alias("hash"))
    plan = decontaminate._hits(tokens, signature, 5, F.col("run") == 5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    found = decontaminate.contained(docs, items, broadcast_rows=10)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in range(0, 30, 3)}


@pytest.mark.parametrize("runs,fan_in,rounds", [(16, 2, 4), (1, 2, 0), (7, 2, 3), (27, 3, 3), (64, 8, 2)])
def test_runs_are_merged_in_rounds(spark, monkeypatch, runs, fan_in, rounds):
    """Each round leaves a run of every `fan_in`, sorted by digest, each digest once; the last round leaves one per range."""
    monkeypatch.setattr(exact, "RANGE_ROWS", 500)
    written = []
    plain = exact.stored
    monkeypatch.setattr(exact, "stored", lambda df, purpose: written.append((purpose, plain(df, purpose))) or written[-1][1])
    df = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id % 700) AS text")
    got = exact.keep_one(df, runs=runs, fan_in=fan_in).collect()
    assert all(r.keep_id == r.doc_id % 700 and r.group_size == len(range(r.keep_id, 2000, 700)) for r in got) and len(got) == 2000
    levels = [frame for purpose, frame in written if purpose == "merge-round"]
    assert len(levels) == rounds
    left = runs
    for level in levels:
        left = -(-left // fan_in)
        rows = level.collect()
        assert {r.run for r in rows} <= set(range(left)) and len({(r.run, r.digest) for r in rows}) == len(rows)
        assert sum(r.members for r in rows) == 2000
    if levels:
        assert {r.range for r in levels[-1].collect()} == {0, 1, 2, 3}


def test_a_merge_is_one_pass_over_sorted_runs(spark):
    runs = spark.createDataFrame([], "range int, run int, digest string, bytes int, best struct<less:int,doc_id:bigint>, members bigint")
    plan = exact.merged(runs, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "SortAggregate" in plan and "Python" not in plan


def test_runs_grow_with_the_rows():
    assert [exact.runs_for(n) for n in (0, 10, 1 << 24, 1 << 30)] == [16, 16, 32, 2048]
