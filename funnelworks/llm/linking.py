"""From candidate buckets to components of verified near-duplicates, shared by the fuzzy operators.

A node is the 64-bit hash of a content, so equal contents are one node (for N distinct contents the chance of any false
equality is about N * N / 2**65). No step makes all pairs of a bucket:

1. Each bucket pairs its members with its smallest node; pairs are verified on full sets and linked to components. Most keys
   are of one node alone: they meet as bytes, and only those of several nodes become rows.
2. Buckets that then still hold several components are grouped by the component of their smallest node, and the nodes of a
   group are compared across components: in blocks, by matrix products, with a row only for what is found.

Every link between nodes that share a bucket is thus found, or its ends are in one component already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import CACHED_BYTES, as_bytes, distinct, dropped, numbers, over_batches, slices, stored

#: Bits of a sieve (8 MB at any scale).
SIEVE_BITS = 1 << 26
_PAGE = 32_768
#: In `met_in_buckets`: keys that a task deals out at a time, keys that a call gets on average at most, and nodes of a bucket among
#: those dealt out at a time from which it counts as large.
KEYS, CALL_KEYS, LARGE = 500_000, 40_000, 100
#: Nodes and bytes of text of a block, and elements that are counted at a time.
BLOCK_ROWS, BLOCK_TEXT, COLUMNS = 1500, 6_000_000, 2048
#: Links (16 bytes each) whose components one task finds.
FEW_LINKS = 100_000
#: Nodes that are compared one by one.
FEW = 12
#: Bits of the sketch of a set (a power of two).
SKETCH = 1024

#: Hashes of the elements of each text's set, in any order and with repeats.
Sets = Callable[[pa.Array], list[np.ndarray]]


def sieve(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size by which rows whose key is not among `keys` can be dropped before a shuffle. It may let others
    pass, the more the more keys there are; the join that follows decides."""
    place = F.pmod(F.col(column), F.lit(SIEVE_BITS))
    pages = (
        keys.select((place / _PAGE).cast("long").alias("page"), (place % _PAGE).alias("bit"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = np.zeros((SIEVE_BITS // _PAGE, _PAGE // 8), np.uint8)
    for row in pages.toLocalIterator():
        out[row.page] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def sifted(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(column).to_numpy(zero_copy_only=False) & (SIEVE_BITS - 1)
            yield batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))

    return over_batches(df, work, ", ".join(f"`{c}` {k}" for c, k in df.dtypes))


def met(rows: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """Rows with the columns that `of` has for their key. `of` comes from an aggregation by the key, whose partitioning a
    plain join would take over, and a hot key with it; on the key and its hash, both sides are dealt anew, and adaptive
    execution can split what is too much for a task."""
    of = of.withColumnRenamed(key, "_key")
    same = (F.col(key) == F.col("_key")) & (F.xxhash64(key) == F.xxhash64("_key"))
    return rows.join(of, same).drop("_key")


def joined_at_once(edges: DataFrame) -> DataFrame:
    """The same for a bounded number of links (u, v): each node points to a smaller one of its component, the root to itself."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            above.setdefault(x, x)
            while above[x] != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(u), root(v)
                above[max(a, b)] = min(a, b)
        nodes = list(above)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "component"]
        )

    return stored(over_batches(edges.coalesce(1), work, "node long, component long"), "components")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each end of a link (a, b) can reach. Alternates large and small stars:
    every node is linked to the smallest of its neighbours instead, until nothing changes. A round's links are removed
    once the next ones are written. Up to FEW_LINKS links are joined in one task instead, which costs less than a round."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if edges.count() <= FEW_LINKS:
        return joined_at_once(edges)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        before, edges = edges, stored(small.unionByName(least.withColumnRenamed("low", "v")).distinct(), "edges")
        dropped(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def shared_elements(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0


def similar(x: np.ndarray, y: np.ndarray, share: tuple[int, int]) -> bool:
    num, den = share
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    common = shared_elements(x, y)
    return den * common >= num * (len(x) + len(y) - common)


def sketched(parts: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set: a bit is on if an element has its number."""
    on = np.zeros((len(parts), SKETCH), bool)
    if parts:
        place = (np.concatenate(parts) >> np.uint64(65 - SKETCH.bit_length())).astype(np.int64)
        on.ravel()[np.repeat(np.arange(len(parts)) * SKETCH, [len(x) for x in parts]) + place] = True
    return np.packbits(on, axis=1).view(np.uint64)


def may_be_similar(size: np.ndarray, bits: np.ndarray, x: np.ndarray, y: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether the sets x and y may be similar enough: each bit that one has and the other has not is an element that is not common,
    of which there are too many in all others. Repeats in `size` let more pass."""
    num, den = share
    apart = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
    return (den + num) * apart <= (den - num) * (size[x] + size[y])


def verified(pairs: DataFrame, texts: DataFrame, sets: Sets, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number: dict[int, int] = {}
            parts: list[np.ndarray] = []
            bits = [sketched([])]
            for side in ("a", "b"):
                nodes, at = np.unique(batch.column(side).to_numpy(), return_index=True)
                at = at[[n not in number for n in nodes.tolist()]]
                for part in slices(batch.select([side, f"text_{side}"]).take(pa.array(at)), f"text_{side}"):
                    number.update(zip(part.column(side).to_pylist(), range(len(parts), len(parts) + part.num_rows)))
                    found = sets(part.column(f"text_{side}"))
                    bits.append(sketched(found))
                    parts += found
            a, b = (np.array([number[n] for n in batch.column(side).to_pylist()], np.int64) for side in "ab")
            keep = may_be_similar(np.array([len(x) for x in parts]), np.concatenate(bits), a, b, share)
            full = {i: distinct(parts[i]) for i in np.unique(np.concatenate([a[keep], b[keep]])).tolist()}
            keep[keep] = [similar(full[i], full[j], share) for i, j in zip(a[keep].tolist(), b[keep].tolist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    rows = rows.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return over_batches(rows.select("a", "b", "text_a", "text_b"), work, "a long, b long")


def found_across(part: list[np.ndarray], component: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of two similar sets for each two components that have any. Common elements are counted for all sets at
    once, as products of 0/1 matrices over a few thousand elements at a time."""
    n = len(part)
    if n <= FEW:
        x, y = np.triu_indices(n, 1)
        across = component[x] != component[y]
        x, y = x[across], y[across]
        may_be = may_be_similar(np.array([len(s) for s in part]), sketched(part), x, y, share)
        x, y = x[may_be], y[may_be]
        full = {i: distinct(part[i]) for i in {*x.tolist(), *y.tolist()}}
        found = np.array([similar(full[i], full[j], share) for i, j in zip(x.tolist(), y.tolist())], bool)
        return x[found], y[found]
    num, den = share
    part = [distinct(s) for s in part]
    size = np.array([len(x) for x in part])
    row = np.repeat(np.arange(n), size)
    element, place, often = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
    number = np.cumsum(often > 1) - 1  # elements of one set alone are not common to any
    common = often[place] > 1
    row, column = row[common], number[place][common]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    inter = np.zeros((n, n), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, (start, start + COLUMNS))
        dense = np.zeros((n, COLUMNS), np.float32)
        dense[row[lo:hi], column[lo:hi] - start] = 1
        inter += dense @ dense.T
    union = size[:, None] + size[None, :] - inter
    x, y = np.nonzero(np.triu((den * inter >= num * union) & (component[:, None] != component[None, :]), 1))
    _, code = np.unique(component, return_inverse=True)
    pair = np.minimum(code[x], code[y]) * np.int64(n) + np.maximum(code[x], code[y])
    _, first = np.unique(pair, return_index=True)
    return x[first], y[first]


def links_across(rows: DataFrame, sets: Sets, share: tuple[int, int]) -> DataFrame:
    """Links (a, b) between nodes of different components within each group, at least one for each two components that have
    any. rows: group, node, component, text; the two nodes of a group of two have been compared before. A large group is cut
    into blocks, and every two blocks meet in a task of their own; small groups are handed out in bundles. So a call holds
    a bounded number of nodes and of bytes, whatever the size of a group."""
    extent = rows.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).where("n > 2")
    extent = stored(extent, "extent")
    total = extent.agg(F.sum("n"), F.sum("bytes")).first()
    bundles = 1 + max((total[0] or 0) // BLOCK_ROWS, (total[1] or 0) // BLOCK_TEXT)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_TEXT)).cast("int")
    dealt = rows.join(extent.select("group", blocks.alias("blocks")), "group").withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") == 1
    dealt = dealt.select(
        F.when(alone, F.pmod(F.xxhash64("group"), F.lit(bundles))).otherwise(F.col("group")).alias("call"), "group",
        F.when(alone, -1).otherwise(F.least("mine", "other")).alias("low"), F.greatest("mine", "other").alias("high"),
        "node", "component", "text",
    )

    def work(table: pa.Table) -> pa.Table:
        group, node, component = (table.column(c).to_numpy() for c in ("group", "node", "component"))
        part: list[np.ndarray] = []
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for piece in slices(batch, "text", CACHED_BYTES):
                part += sets(piece.column("text"))
        a, b = [], []
        order = np.argsort(group, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if (component[places] != component[places[0]]).any():
                x, y = found_across([part[i] for i in places], component[places], share)
                a.append(node[places[x]])
                b.append(node[places[y]])
        empty = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])})

    return dealt.groupBy("call", "low", "high").applyInArrow(work, "a long, b long")


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all rows one after the other, given as longs or as their bytes, and the node of each."""
    keys, node = batch.column("keys"), batch.column("node").to_numpy(zero_copy_only=False)
    if pa.types.is_list(keys.type):
        return keys.flatten().to_numpy(zero_copy_only=False), np.repeat(node, np.diff(keys.offsets.to_numpy()))
    values, bounds = numbers(keys)
    return values, np.repeat(node, np.diff(bounds))


def by_key(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys that occur more than once, ascending, their nodes, ascending within a key, and the offsets of each key."""
    ascending = np.sort(key)
    again = ascending[1:][ascending[1:] == ascending[:-1]]
    if not len(again):
        return key[:0], node[:0], np.zeros(1, np.int64)
    may_be = np.zeros(1 << 18, bool)
    may_be[again & (len(may_be) - 1)] = True
    at = np.flatnonzero(may_be[key & (len(may_be) - 1)])
    at = at[again[np.minimum(np.searchsorted(again, key[at]), len(again) - 1)] == key[at]]
    at = at[np.lexsort((node[at], key[at]))]
    key = key[at]
    return key, node[at], np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))


def met_in_buckets(keyed: DataFrame, most: int) -> DataFrame:
    """(bucket, lead, node): the smallest node of each bucket that has several, with each other one; of a large bucket only its
    largest node or none, and the bucket. keyed: node and its keys, hashes, about `most` at most.

    Most keys belong to one node. They go to calls by ranges of keys, as bytes and not as rows. Of a bucket with LARGE nodes
    among the KEYS that a task deals out at a time, only the smallest and the largest of these are handed on, so that a call holds a
    bounded number, whatever the size of a bucket."""
    calls = 1 + keyed.count() * most // CALL_KEYS

    def dealt(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        again, nodes, bounds = by_key(key, node)
        first, last = (x[np.diff(bounds) >= LARGE] for x in (bounds[:-1], bounds[1:] - 1))
        large = again[first]
        if len(large):
            stays = large[np.minimum(np.searchsorted(large, key), len(large) - 1)] != key
            key = np.concatenate([key[stays], large, large])
            node = np.concatenate([node[stays], nodes[first], nodes[last]])
        call = (((key >> 32) + 2**31) * calls) >> 32
        order = np.argsort(call.astype(np.uint16) if calls <= 1 << 16 else call, kind="stable")
        starts = np.flatnonzero(np.diff(call[order], prepend=-1))
        ends = np.append(starts, len(key))
        dealt_to = call[order[starts]]
        of_large = np.searchsorted((((large >> 32) + 2**31) * calls) >> 32, np.append(dealt_to, calls))
        return pa.RecordBatch.from_arrays(
            [pa.array(dealt_to), as_bytes(key[order], ends), as_bytes(node[order], ends), as_bytes(large, of_large)],
            names=["call", "keys", "nodes", "large"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            have.append(flat(batch))
            if sum(len(key) for key, _ in have) >= KEYS:
                yield dealt(*map(np.concatenate, zip(*have)))
                have = []
        if have:
            yield dealt(*map(np.concatenate, zip(*have)))

    def found(table: pa.Table) -> pa.Table:
        key, node, large = (numbers(table.column(c).combine_chunks())[0] for c in ("keys", "nodes", "large"))
        key, node, bounds = by_key(key, node)
        lead = np.repeat(node[bounds[:-1]], np.diff(bounds))
        is_large = np.isin(key, large)
        last = np.zeros(len(key), bool)
        last[bounds[1:] - 1] = True
        stays = (node != lead) & (last | ~is_large)
        bucket = pa.array(key[stays], mask=~is_large[stays])
        return pa.table({"bucket": bucket, "lead": lead[stays], "node": node[stays]})

    parts = over_batches(keyed.select("node", "keys"), work, "call long, keys binary, nodes binary, large binary")
    return parts.groupBy("call").applyInArrow(found, "bucket long, lead long, node long")


def members_of(keyed: DataFrame, bits: np.ndarray) -> DataFrame:
    """(bucket, node) of the keys that the sieve lets pass, sifted before they become rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner = flat(batch)
            place = keys & (SIEVE_BITS - 1)
            on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([pa.array(keys[on]), pa.array(owner[on])], names=["bucket", "node"])

    return over_batches(keyed, work, "bucket long, node long")


def linked(
    keyed: DataFrame, fetch: Callable[[DataFrame], DataFrame], sets: Sets, share: tuple[int, int], most: int = 1
) -> DataFrame:
    """(node, component) of all nodes with a link. keyed: node and its bucket keys, about `most` at most, written; fetch:
    (node, text) of given nodes."""
    members = stored(met_in_buckets(keyed, most), "shared-buckets")
    large = members.where("bucket IS NOT NULL").select("bucket", "lead")
    if not large.isEmpty():
        every = members_of(keyed.select("node", "keys"), sieve(large, "bucket")).join(large, "bucket").where("node <> lead")
        members = members.select("lead", "node").unionByName(every.select("lead", "node"))
    pairs = stored(members.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = stored(fetch(stored(nodes, "active")), "active-texts")
    links = stored(verified(pairs, texts, sets, share), "links")
    found = components(links)

    of = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"component_{side}"))
    placed = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    placed = placed.withColumns({f"component_{s}": F.coalesce(f"component_{s}", s) for s in "ab"})
    # a bucket lies within its lead's pairs; leads of one component are one group
    leads = placed.where("component_a <> component_b").select("a").distinct()
    rest = placed.join(leads, "a").withColumn("group", F.col("component_a"))
    members = F.explode(F.array(*[F.struct(F.col(s).alias("node"), F.col(f"component_{s}").alias("component")) for s in "ab"]))
    rest = stored(rest.select("group", members.alias("x")).select("group", "x.*").distinct(), "several-components")
    if rest.isEmpty():
        return found
    more = stored(links_across(rest.join(texts, "node"), sets, share), "links-across")
    if more.isEmpty():
        return found
    # what is known is contracted: the late links join components, of which few are left
    placed = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    joins = placed.select(*[F.coalesce(f"component_{s}", s).alias(s) for s in "ab"])
    joined = components(joins).select(F.col("node").alias("component"), F.col("component").alias("final"))
    alone = joined.join(found, "component", "left_anti").select(F.col("component").alias("node"), "final")
    known = found.join(joined, "component", "left").select("node", F.coalesce("final", "component").alias("final"))
    return known.unionByName(alone).withColumnRenamed("final", "component")
