"""A trie of the prefixes that conversations share, built by peeling from the deepest turn upwards.

A conversation is a path: the concatenated codes of its turns, of fixed width, so that the prefix of depth d is the first
d codes. Peeling goes down from the greatest depth: the conversations that end there are merged with the nodes that the
level below has handed up, equal paths becoming one node; every node is complete then, is written, loses the last code of its
path and is handed up as a child. Nodes are found and all their sums are made in this one descent.

A level is one aggregation with map-side reduction, so a path that a third of all conversations begin with is no single
task. Levels with few rows are peeled several at a time, by one task per prefix that their paths share, where rows and bytes of
the block are bounded: a few long conversations do not cost a job per turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import local_table, work_dir
from .shared import over_batches, stored

#: Bytes of a turn's code: the 128-bit digest of role and text, and the number of UTF-8 bytes of the text.
DIGEST, CODE = 16, 20
#: Up to so many rows (conversations times levels) and bytes of paths are peeled as one block.
BLOCK_ROWS, BLOCK_BYTES = 50_000, 64_000_000
#: Ids of one node that are joined to one text.
CHUNK = 20_000
_SUMS = ("n", "children", "leaves", "saved", "ended")
_NODE = (
    "id binary, parent binary, depth long, conv long, n long, children long, leaves long, saved long, ended long, ender long, "
    "path binary"
)


def turn_code(role: Column, text: Column) -> Column:
    """The code of a turn in hexadecimal digits; a missing role or text is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def rebuilt(conversations: DataFrame, every: int = 5, share: int = 9) -> DataFrame:
    """conv_id and path of the conversation rebuilt on the beginning of conversation conv_id - conv_id % every: its first
    crc32(conv_id) % share turns, then the conversation's own turns after as many.

    Turns are ordered by turn, a missing one first, and equal ones by their code. Rows without a conv_id belong to no
    conversation. The texts are reduced to codes before they are shuffled, once, by the shared conversation.
    """
    most = share - 1
    turns = conversations.where("conv_id IS NOT NULL").select(
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"), "conv_id", "turn", turn_code(F.col("role"), F.col("text")).alias("code")
    )
    turns = turns.repartition("base").groupBy("base", "conv_id")
    codes = turns.agg(F.sort_array(F.collect_list(F.struct("turn", "code"))).alias("turns")).withColumn("codes", F.col("turns.code"))
    own = F.col("conv_id") == F.col("base")
    begin = F.max(F.when(own, F.slice("codes", 1, most))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % share).cast("int")
    rows = codes.select("conv_id", "codes", own.alias("own"), F.coalesce(begin, F.array().cast("array<string>")).alias("begin"), h.alias("h"))
    joined = F.when(F.col("own"), F.col("codes")).otherwise(
        F.concat(F.slice("begin", F.lit(1), F.col("h")), F.slice("codes", F.col("h") + 1, F.size("codes")))
    )
    return rows.select("conv_id", F.unhex(F.array_join(joined, "")).alias("path"))


def blocks(lengths: dict[int, int], rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Ranges of depths (from, to), deepest first, that are peeled together; lengths: number of conversations per length."""
    out: list[tuple[int, int]] = []
    alive = total = 0
    top = max(lengths, default=-1)
    for depth in range(top, -1, -1):
        alive += lengths.get(depth, 0)
        total += alive
        if depth < top and (total > rows or alive * CODE * top > size):
            out.append((depth + 1, top))
            top, total = depth, alive
    return [*out, (0, top)] if top >= 0 else []


def handed_up(nodes: DataFrame, low: int) -> DataFrame:
    """The nodes of depth `low` as children of the level above: paths without their last turn."""
    return nodes.where(F.col("depth") == low).select(
        F.substring("path", 1, CODE * (low - 1)).alias("path"), "conv", "n", F.lit(1).cast("long").alias("children"), "leaves", "saved",
        F.lit(0).cast("long").alias("ended"), F.lit(None).cast("long").alias("ender"),
    )


def one_level(items: DataFrame, depth: int) -> DataFrame:
    """Nodes of one depth from the conversations that end there and the children handed up."""
    merged = items.groupBy("path").agg(F.min("conv").alias("conv"), F.min("ender").alias("ender"), *[F.sum(c).alias(c) for c in _SUMS])
    weight = F.conv(F.hex(F.expr(f"substring(path, {CODE * depth - 3}, 4)")), 16, 10).cast("long") if depth else F.lit(0)
    digest = lambda path: F.unhex(F.md5(path))
    above = digest(F.substring("path", 1, CODE * (depth - 1))) if depth else F.lit(None).cast("binary")
    return merged.select(
        digest(F.col("path")).alias("id"), above.alias("parent"), F.lit(depth).cast("long").alias("depth"), "conv", "n", "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * weight).alias("saved"), "ended", "ender", "path",
    )


def peel(items: list[tuple], low: int) -> Iterator[tuple]:
    """Nodes of depth `low` and more of items (path, conv, n, children, leaves, saved, ended, ender) whose prefixes of
    depth `low` do not occur elsewhere; nodes of depth `low` keep their path."""
    first = max(low - 1, 0)
    levels: dict[int, dict[bytes, list]] = {}

    def add(depth: int, key: bytes, conv, n, children, leaves, saved, ended, ender, chain) -> None:
        have = levels.setdefault(depth, {}).get(key)
        if have is None:
            levels[depth][key] = [conv, n, children, leaves, saved, ended, ender, chain]
            return
        have[0] = min(have[0], conv)
        for k, x in enumerate((n, children, leaves, saved, ended), 1):
            have[k] += x
        have[6] = ender if have[6] is None else have[6] if ender is None else min(have[6], ender)

    for path, *rest in items:
        depth = len(path) // CODE
        running = hashlib.md5(path[: CODE * first])
        digests = [running.digest()]
        for d in range(first, depth):
            running.update(path[CODE * d : CODE * (d + 1)])
            digests.append(running.copy().digest())
        add(depth, digests[-1], *rest, (path, digests))
    for depth in range(max(levels, default=-1), low - 1, -1):
        for key, (conv, n, children, leaves, saved, ended, ender, chain) in levels.pop(depth, {}).items():
            path, digests = chain
            above = digests[depth - 1 - first] if depth else None
            leaves = leaves if children else 1
            saved += (n - 1) * int.from_bytes(path[CODE * depth - 4 : CODE * depth], "big") if depth else 0
            yield key, above, depth, conv, n, children, leaves, saved, ended, ender, path[: CODE * low] if depth == low else None
            if depth > low:
                add(depth - 1, above, conv, n, 1, leaves, saved, 0, None, chain)


def one_block(items: DataFrame, low: int) -> DataFrame:
    """Nodes of all depths from `low` on, by tasks that hold all paths of the same beginning; the block is of bounded size."""
    names = [part.split()[0] for part in _NODE.split(", ")]
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.binary()]
    order = ["path", "conv", "n", "children", "leaves", "saved", "ended", "ender"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in order))]
        found = list(peel(rows, low))
        for start in range(0, len(found), 10_000):
            columns = zip(*found[start : start + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return over_batches(items.repartition(F.substring("path", 1, CODE * low)), work, _NODE)


def nodes(paths: DataFrame, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """All nodes of the trie: id, parent (ids), depth, conv (smallest member), n (members), children, leaves, saved, ended (members
    that end here) and ender (the smallest of them). paths: conv_id, path; read several times, so it must be a written table."""
    spark = paths.sparkSession
    ends = paths.groupBy("path").agg(F.min("conv_id").alias("conv"), F.count("*").alias("n"))
    ends = stored(ends.withColumn("size", (F.octet_length("path") / CODE).cast("long")), "trie-ends")
    alive = paths.groupBy((F.octet_length("path") / CODE).cast("long").alias("size")).count()
    lengths = {r["size"]: r["count"] for r in alive.collect()}
    plan = blocks(lengths, rows, size)
    folder = work_dir(spark, "llm-trie")
    if not plan:
        return spark.createDataFrame([], _NODE).drop("path")
    # the conversations that end in each block lie in a folder of their own
    block_of = {depth: number for number, (low, high) in enumerate(plan) for depth in range(low, high + 1)}
    table = local_table(spark, size=[*lengths], block=[block_of[length] for length in lengths])
    placed = ends.join(table, "size").drop("size")
    endings = work_dir(spark, "llm-trie-blocks")
    placed.repartitionByRange("block", "conv").write.partitionBy("block").parquet(endings)
    placed = spark.read.schema("path binary, conv long, n long, block long").parquet(endings)
    zero = F.lit(0).cast("long")
    above = None
    for number, (low, high) in enumerate(plan):
        items = placed.where(F.col("block") == number).select(
            "path", "conv", "n", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"), F.col("n").alias("ended"),
            F.col("conv").alias("ender"),
        )
        items = items if above is None else items.unionByName(above)
        made = one_level(items, low) if low == high else one_block(items, low)
        made.write.parquet(f"{folder}/block={number}")
        above = handed_up(spark.read.schema(_NODE).parquet(f"{folder}/block={number}"), low)
    return spark.read.schema(f"{_NODE}, block int").parquet(folder).drop("path", "block")


def digests_of_ends(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """id and the SHA-256 of the conv_ids of each id, ascending and joined by commas. Ids are sorted over all tasks and joined
    to long texts there; only these meet in the task that hashes them one after the other."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])],
                names=["id", "first", "joined"],
            )

        for batch in batches:
            for key, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (key != now or len(held) >= chunk):
                    yield emit()
                    held = []
                now = key
                held.append(conv)
        if held:
            yield emit()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for key, joined in zip(batch.column("id").to_pylist(), batch.column("joined").to_pylist()):
                if key == now:
                    running.update(b",")
                else:
                    if running is not None:
                        done.append((now, running.hexdigest()))
                    now, running = key, hashlib.sha256()
                running.update(joined.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done]) for k in (0, 1)], names=["id", "sha"])
                done = []
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])], names=["id", "sha"])

    ranged = members.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    joined = over_batches(ranged, chunks, "id binary, first long, joined string")
    return over_batches(joined.repartition("id").sortWithinPartitions("id", "first"), hashes, "id binary, sha string")


def prefix_trie(paths: DataFrame, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """A row per distinct prefix of the paths: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. paths: conv_id (present, unique) and path.

    The root is there if there is any conversation. Codes and node ids are 128-bit digests; N turns of different content
    have a chance of about N * N / 2**129 that two of them are taken for one. A path (20 bytes a turn) lies in one row.
    """
    paths = stored(paths, "trie-paths")
    every = nodes(paths, rows, size)
    # most nodes are the end of no conversation or of one; the others get the digest of their list by a join
    shared = every.where("ended > 1")
    members = paths.select(F.unhex(F.md5("path")).alias("id"), "conv_id").join(shared.select("id"), "id", "left_semi")
    listed = shared.join(stored(digests_of_ends(members), "trie-ends-digests"), "id")
    found = every.where("ended <= 1").withColumn("sha", F.lit(None).cast("string")).unionByName(listed)
    parents = every.where("children > 0").select(F.col("id").alias("of"), F.col("conv").alias("parent_conv_id"))
    out = found.join(parents, F.col("parent") == F.col("of"), "left")
    alone = F.sha2(F.when(F.col("ended") == 1, F.col("ender").cast("string")).otherwise("").cast("binary"), 256)
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", alone).alias("ends_sha256"),
    )


#: Every prefix of every conversation, and every pair of a prefix and a longer one.
ORACLE = r"""
WITH t AS (SELECT conv_id, strlen(coalesce(text, '')) AS bytes,
                  md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS code, turn
           FROM conversations WHERE conv_id IS NOT NULL),
  o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code, bytes) AS pos FROM t),
  c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS own,
               xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                 lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)) % 9 AS h
        FROM t GROUP BY conv_id),
  l AS (SELECT c.conv_id, c.base, c.h, coalesce(least(c.h, b.own), 0) AS lent FROM c LEFT JOIN c b ON b.conv_id = c.base),
  r AS (SELECT l.conv_id, o.pos AS depth, o.code, o.bytes FROM l JOIN o ON o.conv_id = l.base AND (o.pos <= l.h OR l.conv_id = l.base)
        UNION ALL
        SELECT l.conv_id, o.pos - l.h + l.lent, o.code, o.bytes FROM l JOIN o USING (conv_id) WHERE o.pos > l.h AND l.conv_id <> l.base),
  m AS MATERIALIZED (SELECT conv_id, depth, bytes, md5(string_agg(code, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
        UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
  e AS (SELECT arg_max(key, depth) AS key, conv_id FROM m GROUP BY conv_id),
  s AS (SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM e GROUP BY key),
  n AS MATERIALIZED (SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes
        FROM m GROUP BY key),
  up AS (SELECT DISTINCT a.key, b.key AS above FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1),
  kids AS (SELECT above AS key, count(*) AS n_children FROM up GROUP BY above),
  sub AS (SELECT DISTINCT a.key, b.key AS below FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
  sums AS (SELECT sub.key, count(*) FILTER (kids.key IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
           FROM sub JOIN n ON n.key = sub.below LEFT JOIN kids ON kids.key = sub.below GROUP BY sub.key)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, sums.n_leaves,
       sums.saved_tokens, sha256(coalesce(s.ends, '')) AS ends_sha256
FROM n JOIN sums ON sums.key = n.key LEFT JOIN up ON up.key = n.key LEFT JOIN n p ON p.key = up.above
LEFT JOIN kids ON kids.key = n.key LEFT JOIN s ON s.key = n.key
"""
