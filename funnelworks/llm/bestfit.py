"""Best-fit packing whose bins are emptied by a local search over swaps.

Documents longer than a sequence are cut into whole sequences behind a first piece that holds the rest, so each document is
one item of less than a sequence at most. Items are dealt to groups of bounded size by their numbers. In a group, best fit in order of
decreasing length gives the first bins. Then, from the emptiest bin on, items leave a bin for underfull ones: one moves, one
is exchanged for one, one for two, or two for one. Every step raises the sum of the squared fills; steps go on as long as bins
become empty. The emptiest bins of all groups are packed together once more, level by level, until one group is left.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import SEQUENCE, checksum, encode
from .shared import bounded, over_batches, slices, stored

#: Items that a task packs together, and the part of them, those in the emptiest bins, that the next level packs again.
GROUP, AGAIN = 20_000, 8
#: Bits of a sequence_id for the bin within its group, and for the group within its level.
_BIN, _PLACE = 24, 54


# ---- one group
def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers: longest items first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]  # by the room they have left
    rooms = 0  # bit r is set if there are bins with room r
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
            bins[b].append(item)
        else:
            b, room = len(bins), size
            bins.append([item])
        if left := room - n:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins


class Slots:
    """Places in underfull bins: what leaves (nothing, one item or two) and the room there is then for what comes.

    A slot is worth using for a total of n if its room is at least n and what leaves is less. Slots are found by their room,
    and among equal rooms by how much the bin gains.
    """

    def __init__(self, size: int):
        self.size = size
        self.rooms = 0
        self.gains: dict[int, int] = defaultdict(int)  # room -> bits of the room that is left in the bins as they are
        self.slots: dict[tuple[int, int], dict] = defaultdict(dict)
        self.most = 0

    @staticmethod
    def of(lengths: list[int], size: int, pairs: bool) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """Room, room left now, and the lengths that leave; equal lengths are one slot."""
        left = size - sum(lengths)
        different = sorted(set(lengths))
        if not pairs:
            yield left, left, ()
            for a in different:
                yield left + a, left, (a,)
            return
        twice = {a for a in different if lengths.count(a) > 1}
        for i, a in enumerate(different):
            for b in different[i if a in twice else i + 1 :]:
                yield left + a + b, left, (a, b)

    def add(self, b: int, lengths: list[int], pairs: bool) -> None:
        for room, left, out in self.of(lengths, self.size, pairs):
            self.slots[room, left][b, out] = None
            self.gains[room] |= 1 << left
            self.rooms |= 1 << room
            self.most = max(self.most, left)

    def remove(self, b: int, lengths: list[int], pairs: bool) -> None:
        for room, left, out in self.of(lengths, self.size, pairs):
            held = self.slots[room, left]
            held.pop((b, out), None)
            if not held:
                del self.slots[room, left]
                self.gains[room] &= ~(1 << left)
                if not self.gains[room]:
                    self.rooms &= ~(1 << room)

    def find(self, n: int) -> tuple[int, int, tuple[int, ...]] | None:
        """The slot that leaves its bin fullest: spare room, bin, and lengths that leave."""
        spare = 0
        rooms = self.rooms >> n
        while rooms:
            step = (rooms & -rooms).bit_length() - 1
            spare += step
            if spare >= self.most:
                return None
            left = self.gains[n + spare].bit_length() - 1
            if left > spare:
                b, out = next(iter(self.slots[n + spare, left]))
                return spare, b, out
            rooms >>= step + 1
            spare += 1
        return None


def improve(bins: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """The bins after local search; never more than there were."""
    least = -(-sum(lengths) // size)
    fill = [sum(lengths[i] for i in b) for b in bins]
    by_length: list[dict[int, list[int]]] = []
    for b in bins:
        held: dict[int, list[int]] = defaultdict(list)
        for i in b:
            held[lengths[i]].append(i)
        by_length.append(held)
    sizes = lambda b: [n for n, items in by_length[b].items() for _ in items]
    single, double = Slots(size), Slots(size)

    def enter(b: int) -> None:
        if 0 < fill[b] < size:
            single.add(b, sizes(b), False)
            double.add(b, sizes(b), True)

    def leave(b: int) -> None:
        if 0 < fill[b] < size:
            single.remove(b, sizes(b), False)
            double.remove(b, sizes(b), True)

    def shift(a: int, b: int, given: tuple[int, ...], back: tuple[int, ...]) -> None:
        for source, target, what in ((a, b, given), (b, a, back)):
            for n in what:
                by_length[target][n].append(by_length[source][n].pop())
                if not by_length[source][n]:
                    del by_length[source][n]
        delta = sum(given) - sum(back)
        fill[a] -= delta
        fill[b] += delta

    def step(a: int) -> bool:
        """The exchange that raises the squared fill most, of those that leave a receiving bin fullest."""
        best = None
        mine = sizes(a)
        ways = [(out, slots) for _, _, out in Slots.of(mine, size, False) if out for slots in (single, double)]
        ways += [(out, single) for _, _, out in Slots.of(mine, size, True)]
        for out, slots in ways:
            n = sum(out)
            if n <= size and (slot := slots.find(n)):
                _, b, back = slot
                delta = n - sum(back)
                gain = delta * (fill[b] - fill[a] + delta)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, b, out, back
        if best is None:
            return False
        _, b, out, back = best
        leave(b)
        shift(a, b, out, back)
        enter(b)
        return True

    for b in range(len(bins)):
        enter(b)
    number = sum(1 for f in fill if f)
    while number > least:
        emptied = 0
        for a in sorted((b for b in range(len(bins)) if 0 < fill[b] < size), key=lambda b: fill[b]):
            if not 0 < fill[a] < size:
                continue
            leave(a)
            while fill[a] and step(a):
                pass
            if fill[a]:
                enter(a)
            else:
                emptied += 1
                number -= 1
                if number <= least:
                    break
        if not emptied:
            break
    return [[i for items in held.values() for i in items] for held in by_length if held]


def pack_group(lengths: list[int], size: int) -> list[list[int]]:
    return improve(best_fit(lengths, size), lengths, size)


# ---- all documents
def pieces(documents: DataFrame, path: str, pattern: str, size: int, end: int) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece, and a number that no other piece has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for part in (p for batch in batches for p in slices(batch, "text")):
            owner, rows = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                ids = np.array([*encode(path, pattern, text or ""), end], "<u4")
                first = (len(ids) - 1) % size + 1
                cuts = [0, *range(first, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    owner.append(i)
                    rows.append((k, a, b - a, checksum(ids[a:b]), number))
                    number += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), *[pa.int64()] * 4])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(owner, pa.int64())), *columns], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "number"]
    return over_batches(
        documents.select("doc_id", "text"), work, "doc_id long, piece int, start long, length long, ids_crc32 long, number long"
    )


def packed_groups(items: DataFrame, groups: int, level: int, size: int, last: bool) -> DataFrame:
    """Items with sequence_id and offset; those to be packed again have neither."""

    def work(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        group = table.column("group")[0].as_py()
        bins = pack_group(lengths, size)
        bins.sort(key=lambda b: sum(lengths[i] for i in b))
        again = 0 if last else len(lengths) // AGAIN
        sequence: list[int | None] = [None] * len(lengths)
        offset: list[int | None] = [None] * len(lengths)
        for place, b in enumerate(bins):
            at = sum(lengths[i] for i in b)
            if at < size and again >= len(b):
                again -= len(b)
                continue
            again = 0
            at = 0
            for i in b:
                sequence[i], offset[i] = (level << _PLACE) | (group << _BIN) | place, at
                at += lengths[i]
        out = table.drop_columns(["group"])
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, number long, sequence_id long, offset long"
    bounded(items.sparkSession)
    group = F.pmod(F.xxhash64("number", F.lit(level)), F.lit(groups)).alias("group")
    return items.select("doc_id", "piece", "start", "length", "ids_crc32", "number", group).groupBy("group").applyInArrow(work, schema)


def pack(
    documents: DataFrame, path: str, pattern: str, size: int = SEQUENCE, end: int = 2, group: int = GROUP
) -> DataFrame:
    """Per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A document's ids are those of the vocabulary in `path`, with id `end` behind; a missing or empty text is this id alone.
    A document of up to `size` ids is never cut. Each row is packed by itself, so repeated rows are packed repeatedly; a missing
    doc_id stays missing; other columns are ignored; no documents give no pieces. sequence_ids have gaps.
    """
    made = stored(pieces(documents, path, pattern, size, end), "fit-pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = made.where(F.col("length") == size)
    out = whole.withColumn("sequence_id", -1 - F.col("number")).withColumn("offset", F.lit(0).cast("long")).select(columns)
    left = made.where(F.col("length") < size)
    number = left.count()
    level = 0
    while number:
        groups = -(-number // group)
        done = stored(packed_groups(left, groups, level, size, groups == 1), "fit-level")
        out = out.unionByName(done.where("sequence_id IS NOT NULL").select(columns))
        left = done.where("sequence_id IS NULL")
        number = left.count() if groups > 1 else 0
        level += 1
    return out
