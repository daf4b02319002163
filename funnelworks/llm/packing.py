"""Packing documents into training sequences as a cutting-stock problem, solved by column generation.

Documents are cut into whole sequences and a remainder. The remainders are packed by patterns: how many remainders of which
lengths share a sequence. A linear program over the histogram of lengths chooses how often each pattern is used; a knapsack
by dynamic programming over the dual prices finds the pattern that improves it most, until none does. The histogram has one
entry per length, so the program is of the same size for any corpus. Rounded patterns give, for each length, ranges of ranks;
documents are ranked within their length and find their sequence and offset by a join with this small table.

What rounding leaves is cut into powers of two by the binary digits of its length. Laid out from large to small, such pieces
fill sequences without gaps; the end of the layout is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import local_table
from .shared import over_batches, slices, stored
from .tokens import byte_letters

SEQUENCE = 1024
#: Padding that one avoided cut of a document is worth, and the price of a sequence that is short but needs no padding.
CUT_PRICE, SHORT_PRICE = 1.0, 0.25
#: Documents of one length that a task ranks (about, at most), and the buckets that any length is dealt to at least.
RANKED, SPREAD = 1 << 18, 16
#: Pivots after which the linear program is taken as good enough; any of its states is a valid packing.
PIVOTS = 500
#: White-space characters in a row from which a run is encoded by itself, in a text that the library refuses; and what is
#: white space to the library (Python's own class has four characters more).
LONG_RUN = 100_000
_BLANKS = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


# ---- tokens
@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    """The vocabulary in a library that is several times faster. It merges in the order of the ids, which must therefore be
    the order of the merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    if made != sorted(made):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, pattern: str, text: str) -> list[int]:
    """The ids of a text. The library has no room for about a million white-space characters in a row."""
    try:
        return encoder(path, pattern).encode(text, allowed_special="all")
    except ValueError:
        return encode_in_parts(path, pattern, text)


def encode_in_parts(path: str, pattern: str, text: str, least: int = LONG_RUN) -> list[int]:
    """The same ids, with runs of `least` (two or more) white-space characters cut out by the rule of the pattern: a run is one
    piece, without its last character if anything but a special token follows."""
    machine, piece = encoder(path, pattern), encoder(path, r"(?s).+")
    special = tuple(machine.special_tokens_set)
    out: list[int] = []
    at = 0
    for run in re.finditer(f"{_BLANKS}{{{least},}}", text):
        end = run.end() if run.end() == len(text) or text.startswith(special, run.end()) else run.end() - 1
        out += machine.encode(text[at : run.start()], allowed_special="all")
        out += piece.encode(text[run.start() : end], allowed_special="all")
        at = end
    return out + machine.encode(text[at:], allowed_special="all")


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


def tokenized(documents: DataFrame, path: str, pattern: str, size: int, end: int = 0) -> DataFrame:
    """A row per whole sequence, with its sequence_id (odd), and one per remainder, with a number of its own (even) instead and
    the checksums of its cut in powers of two: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for part in (p for batch in batches for p in slices(batch, "text")):
            owner, rows = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                ids = np.array([*encode(path, pattern, text or ""), end], "<u4")
                n = len(ids)
                for start in range(0, n - size + 1, size):
                    owner.append(i)
                    rows.append((start, size, checksum(ids[start : start + size]), n, 2 * number + 1, None))
                    number += 1
                if rest := n % size:
                    owner.append(i)
                    cuts = np.cumsum([n - rest, *powers_of_two(rest)])
                    parts = [checksum(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                    rows.append((n - rest, rest, checksum(ids[n - rest :]), n, 2 * number, parts))
                    number += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [*[pa.int64()] * 5, pa.list_(pa.int64())])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owner, pa.int64())), *columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "parts"],
            )

    return over_batches(
        documents.select("doc_id", "text"), work,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, parts array<long>",
    )


# ---- the linear program
def waste(size: int) -> np.ndarray:
    """Price of a sequence by the tokens in it: its padding, or a little if it is short and a power of two."""
    fill = np.arange(size + 1)
    price = (size - fill).astype(float)
    power = (fill & (fill - 1)) == 0
    price[power] = SHORT_PRICE * (1 - fill[power] / size)
    price[0] = np.inf
    return price


def best_pattern(lengths: np.ndarray, prices: np.ndarray, size: int, cost: np.ndarray) -> tuple[float, dict[int, int]]:
    """The pattern that gains most at these prices of the lengths, by a knapsack over exact fills."""
    use = prices > 1e-9
    item, price, index = lengths[use], prices[use], np.flatnonzero(use)
    value, last = np.full(size + 1, -np.inf), np.full(size + 1, -1)
    value[0] = 0
    upto = np.searchsorted(item, np.arange(size + 1), side="right")
    for fill in range(1, size + 1):
        if k := upto[fill]:
            found = value[fill - item[:k]] + price[:k]
            j = int(found.argmax())
            value[fill], last[fill] = found[j], j
    gain = value - cost
    fill = int(gain.argmax())
    best, pattern = float(gain[fill]), {}
    while fill > 0 and last[fill] >= 0:
        i = int(index[last[fill]])
        pattern[i] = pattern.get(i, 0) + 1
        fill -= int(lengths[i])
    return best, pattern


def choose_patterns(lengths: np.ndarray, demand: np.ndarray, size: int, pivots: int = PIVOTS) -> list[tuple[dict[int, int], int]]:
    """Patterns (index of the length: count) and how often to use each, never more than there are documents.

    Simplex on: sum of the prices of the sequences and cuts, where for every length the patterns and the cut documents
    together make up the demand. It starts with patterns for the lengths that have most left, each used until one of its
    lengths runs out, and with the rest cut.
    """
    m = len(lengths)
    cost = waste(size)
    cuts = np.array([CUT_PRICE * (int(x).bit_count() - 1) for x in lengths], float)
    basis: list[dict[int, int] | None] = [None] * m
    price, start, left = cuts.copy(), np.eye(m), demand.astype(float)
    for _ in range(m):
        worth = 64 * lengths / size * (1 + left / max(left.max(), 1e-9))  # long ones first, and what there is most of
        gain, pattern = best_pattern(lengths, np.where(left > 0, worth, 0), size, 128 * cost)
        if gain < 1e-6:
            break
        items, number = np.array([*pattern]), np.array([*pattern.values()])
        times = left[items] / number
        out = int(items[times.argmin()])
        left[items] = np.maximum(left[items] - times.min() * number, 0)
        left[out] = 0
        basis[out], price[out] = pattern, cost[int(lengths[items] @ number)]
        start[:, out] = 0
        start[items, out] = number
    inverse = np.linalg.inv(start)
    x = np.maximum(inverse @ demand, 0)
    for _ in range(pivots if m else 0):
        dual = price @ inverse
        gain, pattern = best_pattern(lengths, dual, size, cost)
        slack = dual - cuts  # a cut that was left out may pay again
        if max(gain, slack.max()) < 1e-6:
            break
        if slack.max() > gain:
            column, entering, c = inverse[:, int(slack.argmax())].copy(), {int(slack.argmax()): -1}, cuts[slack.argmax()]
        else:
            fill = sum(int(lengths[i]) * k for i, k in pattern.items())
            column, entering, c = sum(k * inverse[:, i] for i, k in pattern.items()), pattern, cost[fill]
        up = column > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, column, 1), np.inf)
        out = int(ratio.argmin())
        step = max(ratio[out], 0.0)
        x = np.maximum(x - step * column, 0)
        x[out] = step
        row = inverse[out] / column[out]
        touched = np.flatnonzero(np.abs(column) > 1e-12)
        inverse[touched] -= np.outer(column[touched], row)
        inverse[out] = row
        basis[out] = None if -1 in entering.values() else entering
        price[out] = c
    left = demand.astype(np.int64).copy()
    chosen = []
    for k in np.argsort(-(x - np.floor(x + 1e-9)), kind="stable"):
        if basis[k]:
            times = min(int(np.floor(x[k] + 1e-9)), *(int(left[i]) // n for i, n in basis[k].items()))
            if times > 0:
                chosen.append([basis[k], times])
                for i, n in basis[k].items():
                    left[i] -= n * times
            elif x[k] > 1e-6:
                chosen.append([basis[k], 0])
    for entry in chosen:  # round up where documents are left for it
        pattern = entry[0]
        if all(left[i] >= n for i, n in pattern.items()):
            entry[1] += 1
            for i, n in pattern.items():
                left[i] -= n
    return [(p, t) for p, t in chosen if t]


def layout(lengths: np.ndarray, demand: np.ndarray, size: int, pivots: int = PIVOTS) -> tuple[list[tuple], list[tuple], int, int]:
    """Where documents go by length and rank: rows (length, from, to, per sequence, first offset, first sequence) of the
    patterns; rows (length, part, power, from rank, first position) of the cut rest; sequences of the patterns; tokens of the
    rest."""
    used = np.zeros(len(lengths), np.int64)
    places, sequences = [], 0
    for pattern, times in choose_patterns(lengths, demand, size, pivots):
        offset = 0
        for i, n in sorted(pattern.items(), key=lambda p: -int(lengths[p[0]])):
            places.append((int(lengths[i]), int(used[i]), int(used[i] + n * times), n, offset, sequences))
            used[i] += n * times
            offset += n * int(lengths[i])
        sequences += times
    rest, position = [], 0
    for power in powers_of_two(2 * size - 1):
        for i, length in enumerate(lengths.tolist()):
            if length & power and demand[i] > used[i]:
                rest.append((length, powers_of_two(length).index(power), power, int(used[i]), position))
                position += power * int(demand[i] - used[i])
    return places, rest, sequences, position


def pack(documents: DataFrame, path: str, pattern: str, size: int = SEQUENCE, most: int = RANKED) -> DataFrame:
    """Per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A document's ids are those of the vocabulary in `path`, with id 0 at the end; a missing text is empty and has this id
    alone. Each row is packed by itself, so repeated rows are packed repeatedly; a missing doc_id stays missing. Sequences
    hold up to `size` tokens, a power of two.
    """
    spark = documents.sparkSession
    pieces = stored(tokenized(documents, path, pattern, size), "pieces")
    whole = pieces.where("parts IS NULL").drop("parts").withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.where("parts IS NOT NULL").withColumnRenamed("sequence_id", "piece")
    histogram = rest.groupBy("length").count().orderBy("length").collect()
    # ranks within a length: dealt to as many buckets as its number of documents needs, so that a length that a third of them
    # have is no single task
    column = lambda values: pa.array(values, pa.int64())
    dealt = local_table(spark, length=column([r[0] for r in histogram]), buckets=column([max(-(-r[1] // most), SPREAD) for r in histogram]))
    bucket = F.pmod(F.xxhash64("piece"), F.col("buckets")).cast("int")
    rest = rest.join(F.broadcast(dealt), "length").withColumn("bucket", bucket).drop("buckets", "piece")
    counts = stored(rest.groupBy("length", "bucket").count(), "lengths")
    lengths, demand = (np.array([r[k] for r in histogram], np.int64) for k in (0, 1))
    places, cuts, sequences, tokens = layout(lengths, demand, size)

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "ids_crc32", "start")
    ranked = rest.withColumn("number", F.row_number().over(within)).join(F.broadcast(bases), ["length", "bucket"])
    ranked = stored(ranked.withColumn("rank", F.col("base") + F.col("number") - 1).drop("bucket", "base", "number"), "ranked")

    table = spark.createDataFrame(places, "length long, low long, high long, each long, first long, sequence long")
    inside = ranked.join(F.broadcast(table), "length").where("rank >= low AND rank < high")
    inside = inside.withColumns({
        "sequence_id": F.expr("2 * (sequence + (rank - low) div each)"),
        "offset": F.expr("first + (rank - low) % each * length"),
    })

    table = spark.createDataFrame(cuts, "length long, part int, power long, low long, position long")
    cut = ranked.join(F.broadcast(table), "length").where("rank >= low").withColumns({
        "position": F.expr("position + (rank - low) * power"),
        "start": F.expr("start + (length div (2 * power)) * (2 * power)"),
        "ids_crc32": F.expr("parts[part]"),
    })
    cut = cut.drop("length").withColumnRenamed("power", "length")
    # sequences of the cut rest, the last one in powers of two
    full = tokens // size
    ends = np.cumsum([0, *powers_of_two(tokens - full * size)]).tolist()
    last = F.col("position") - full * size
    step = lambda values: F.coalesce(*[F.when(last >= e, F.lit(v)) for e, v in reversed(list(zip(ends, values)))])
    number = F.when(last < 0, F.col("position") / size).otherwise(full + step(range(len(ends)))).cast("long")
    cut = cut.withColumns({
        "sequence_id": 2 * (sequences + number),
        "offset": F.when(last < 0, F.col("position") % size).otherwise(last - step(ends)).cast("long"),
    })

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return whole.select(names).unionByName(inside.select(names)).unionByName(cut.select(names))
