"""Compression of vectors into codes of sixteen parts, by Lloyd rounds that compare with active entries only.

Vectors become integers and are cut into parts, each with a codebook of its own. An entry that an update leaves unchanged is
not active: a part that is assigned to such an entry knows its exact distance, and every other inactive entry lost against it
before, so only the active entries are compared. A part whose own entry has moved is compared with the whole codebook. All
numbers are integers, so both ways give the same assignment, ties included.

Assignments and distances are carried in a written table, one per round; of a round only the codebooks (a fixed number of
entries) reach the driver, as sums made by the tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import dropped, over_batches, stored

#: Parts of a vector, entries of a codebook, rounds of assignment and update, steps of a component between two integers.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Squared distances of a vector stay below this.
ROOM = 2**62


def limit(width: int) -> int:
    """Largest component of vectors of this many numbers, so that no squared distance overflows."""
    return math.isqrt(ROOM // max(width, 1)) // 2


def integers(vector: Column, width: int) -> Column:
    """Components as integers, saturated at the limit; short vectors are filled up with 0."""
    most = limit(width)
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(most))), F.lit(float(-most)))))
    return F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(vector)))


def usable(vector: Column) -> Column:
    """True for a vector of numbers, each of them present and finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, fine), F.lit(False))


def nearest(part: np.ndarray, book: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the entries `among` (ascending), the one nearest to each row of `part`, the lowest of ties, and its squared distance."""
    total = np.zeros((len(part), len(among)), np.int64)
    for k in range(part.shape[1]):
        step = part[:, k, None] - book[among, k]
        total += step * step
    best = total.argmin(1)
    return among[best], total[np.arange(len(part)), best]


def assign(
    parts: np.ndarray, books: np.ndarray, active: np.ndarray, codes: np.ndarray | None = None, errors: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part: parts[row, position, component], books[position, entry, component],
    active[position, entry]; codes and errors as they were before the active entries moved, None at first."""
    rows, positions, entries = len(parts), len(books), books.shape[1]
    every = np.arange(entries)
    new_codes, new_errors = np.empty((rows, positions), np.int64), np.empty((rows, positions), np.int64)
    for p in range(positions):
        if codes is None:
            new_codes[:, p], new_errors[:, p] = nearest(parts[:, p], books[p], every)
            continue
        code, error = codes[:, p].copy(), errors[:, p].copy()
        lost = active[p][code]
        moved = np.flatnonzero(active[p])
        if len(moved):
            at = np.flatnonzero(~lost)
            found, distance = nearest(parts[at, p], books[p], moved)
            wins = (distance < error[at]) | ((distance == error[at]) & (found < code[at]))
            code[at[wins]], error[at[wins]] = found[wins], distance[wins]
            at = np.flatnonzero(lost)
            code[at], error[at] = nearest(parts[at, p], books[p], every)
        new_codes[:, p], new_errors[:, p] = code, error
    return new_codes, new_errors


def matrix(column: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    """An Arrow column of lists of equal length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def assigned(rows: DataFrame, books: np.ndarray, active: np.ndarray, first: bool) -> DataFrame:
    """vec_id, label and vector with codes and errors of this round."""
    positions, _, length = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = matrix(batch.column("vector"), positions * length).reshape(-1, positions, length)
            before = () if first else (matrix(batch.column("codes"), positions), matrix(batch.column("errors"), positions))
            codes, errors = assign(parts, books, active, *before)
            ends = pa.array(np.arange(len(parts) + 1) * positions, pa.int32())
            listed = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (codes, errors)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "vector")), *listed],
                names=["vec_id", "label", "vector", "codes", "errors"],
            )

    label = dict(rows.dtypes)["label"]
    return over_batches(rows, work, f"vec_id long, label {label}, vector array<long>, codes array<long>, errors array<long>")


def totals(state: DataFrame, positions: int, entries: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of parts of every entry, and the sums of their components. Each task sums its own rows; sums of tasks are
    added by entry, so at most positions * entries rows reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((positions * entries, length + 1), np.int64)
        for batch in batches:
            parts = matrix(batch.column("vector"), positions * length).reshape(-1, positions, length)
            codes = matrix(batch.column("codes"), positions)
            for p in range(positions):
                order = np.argsort(codes[:, p], kind="stable")
                held, starts, counts = np.unique(codes[order, p], return_index=True, return_counts=True)
                if len(held):
                    sums[p * entries + held, :length] += np.add.reduceat(parts[order, p], starts, axis=0)
                    sums[p * entries + held, length] += counts
        used = np.flatnonzero(sums[:, length])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(sums[used, k]) for k in range(length + 1))], names=["entry", *names]
        )

    names = [f"sum_{k}" for k in range(length)] + ["number"]
    made = over_batches(state.select("vector", "codes"), work, "entry long, " + ", ".join(f"{n} long" for n in names))
    got = made.groupBy("entry").agg(*[F.sum(n).alias(n) for n in names]).collect()
    sums = np.zeros((positions * entries, length + 1), np.int64)
    for row in got:
        sums[row[0]] = row[1:]
    sums = sums.reshape(positions, entries, length + 1)
    return sums[:, :, length], sums[:, :, :length]


def updated(books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the floored means, unused entries as they were, and which entries moved."""
    new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
    return new, (new != books).any(2)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Per usable vector: vec_id, code (two hex digits a part), error, label_error and codebooks_sha256; and the codebooks
    [part, entry, component].

    A vector that is null, or holds a null, NaN or infinite component, is dropped. Components are floor(256 * x), saturated
    at `limit`, beyond which a squared distance would overflow. Vectors shorter than the longest, and all if its length is no
    multiple of `parts`, are filled up with 0. Codebooks start with the smallest vec_ids, a missing vec_id the
    largest, repeated ones in the order of their vectors; fewer vectors than `entries` make smaller codebooks. Each row
    counts by itself, so repeated rows count repeatedly. Missing labels are one label. Other columns are ignored; without a
    usable vector there are no rows.
    """
    given = embeddings.select("vec_id", "label", F.col("embedding").alias("vector")).where(usable(F.col("embedding")))
    longest = given.agg(F.max(F.size("vector"))).first()[0] or 0
    length = max(-(-longest // parts), 1)
    rows = given.withColumn("vector", integers(F.col("vector"), parts * length))
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.array([r.vector for r in seeds], np.int64).reshape(-1, parts, length).transpose(1, 0, 2).copy()
    active = np.ones(books.shape[:2], bool)
    state, size = None, books.shape[1]
    for number in range(rounds + 1):
        before = state
        state = stored(assigned(rows if state is None else state, books, active, state is None), "codes") if size else rows
        if before is not None:
            dropped(before)
        if number < rounds and size:
            books, active = updated(books, *totals(state, parts, size, length))
    if not size:
        empty = rows.limit(0).select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")])
        return empty.withColumn("codebooks_sha256", F.lit(digest(books))), books
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    error = F.aggregate("errors", F.lit(0).cast("long"), lambda total, x: total + x)
    found = state.select("vec_id", "label", code.alias("code"), error.alias("error"))
    # summed before the join and written, so that a label of a third of all rows is split there
    sums = stored(found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    out = found.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")), books


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """Every round compares all parts with all entries, which SQL does without active entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
  d{r} AS (SELECT p.row, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
           FROM p JOIN b{r} b ON p.part = b.part),
  a{r} AS MATERIALIZED (SELECT row, part, min(far) AS far, arg_min(entry, (far, entry)) AS entry FROM d{r} GROUP BY row, part)""")
        if r < rounds:
            steps.append(f"""
  s{r} AS (SELECT a.part, a.entry, u.i, floor(sum(u.x)::DECIMAL(38, 0) / count(*))::BIGINT AS mean
           FROM a{r} a JOIN p USING (row, part), unnest(list_zip(p.v, range(1, len(p.v) + 1))) AS t(z), (SELECT z[1] AS x, z[2] AS i) u
           GROUP BY a.part, a.entry, u.i),
  m{r} AS (SELECT part, entry, list(mean ORDER BY i) AS v FROM s{r} GROUP BY part, entry),
  b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (part, entry))""")
    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
                  row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  p AS MATERIALIZED (SELECT row, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS v
                     FROM k, (SELECT unnest(range({parts})) AS part)),
  b0 AS (SELECT part, row AS entry, v FROM p WHERE row < {entries}),{",".join(steps)},
  f AS (SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a{rounds} GROUP BY row),
  h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM k JOIN f USING (row), h
"""


#: For vectors whose common length is a multiple of the parts and whose components are within the limit.
ORACLE = _oracle()
