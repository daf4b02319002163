"""Line deduplication: fuzzy lines by MinHash over character shingles, one line of each component stays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import linked, sieve, sifted
from .neardup import banded, minima
from .shared import CACHED_BYTES, LAST, as_bytes, mixed, over_batches, slices, stored

#: Characters of a shingle (a power of two), wanted similarity, and bands of minima: a pair of similarity 0.8 is missed once in
#: 5,000 times, of 0.85 once in 90,000 times.
SHINGLE, SHARE, BANDS, ROWS = 8, (4, 5), 12, 3
#: Lines that a task remembers so as not to give their keys again.
REMEMBERED = 200_000
#: White space besides blanks and line feeds, of ASCII and beyond.
SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
WIDE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POINTS = np.random.default_rng(20240612).integers(0, 2**64, 1 << 16, dtype=np.uint64)


def plain(line: str) -> str:
    """What lines are compared by: case and the amount of white space do not count."""
    return " ".join(line.lower().split())


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character shingles of all lines one after the other, and the offsets of each line. Lines have at least
    one shingle. Hashes of runs of two characters are made from those of one, those of four from two, and so on."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes = _POINTS[points & 0xFFFF]
    high = points >> 16
    if high.any():
        hashes = hashes ^ mixed(high.astype(np.uint64))
    step = 1
    while step < SHINGLE and len(hashes):
        hashes = hashes[:-step] + hashes[step:] * _ODD**np.uint64(step)
        step *= 2
    whole = np.ones(len(points), bool)  # positions with a shingle within their line
    whole[(np.cumsum(length)[:, None] - np.arange(1, SHINGLE)).ravel()] = False
    return hashes[whole[: len(hashes)]], np.concatenate([[0], np.cumsum(length - SHINGLE + 1)])


def line_sets(column: pa.Array) -> list[np.ndarray]:
    values, bounds = shingles(column.to_pylist())
    return [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def content(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - 2**63


def plain_lines(text: str) -> list[str]:
    """The plain form of all lines of a text. Most texts have single blanks only, and their lines are left as they are."""
    text = text.lower()
    lines = text.split("\n")
    if any(c in text for c in (SPACES if text.isascii() else SPACES + WIDE)):
        return [plain(line) for line in lines]
    double = "  " in text
    return [plain(x) if x[:1] == " " or x[-1:] == " " or double and "  " in x else x for x in lines]


def comparable(text: str | None) -> list[tuple[int, str]]:
    """Number and plain form of the lines that are long enough for a shingle."""
    return [(i, p) for i, p in enumerate(plain_lines(text or "")) if len(p) >= SHINGLE]


def all_lines(rows: DataFrame) -> DataFrame:
    """Per comparable line: doc, row_key, line, the hash of its plain form, and its band keys, which are left out where the
    task has lately given them for an equal line."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for part in (p for batch in batches for p in slices(batch, "text", CACHED_BYTES)):
            found = [(i, k, p) for i, text in enumerate(part.column("text").to_pylist()) for k, p in comparable(text)]
            owner = pa.array([i for i, _, _ in found], pa.int64())
            nodes = [content(p) for _, _, p in found]
            if len(given) > REMEMBERED:
                given.clear()
            new = np.array([not (n in given or given.add(n)) for n in nodes], bool)
            keys = banded(minima(*shingles([found[k][2] for k in np.flatnonzero(new)]), BANDS * ROWS), ROWS)
            ends = np.concatenate([[0], np.cumsum(new * BANDS)])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc").take(owner), part.column("row_key").take(owner), pa.array([k for _, k, _ in found], pa.int32()),
                    pa.array(nodes, pa.int64()),
                    as_bytes(keys.T.ravel(), ends),
                ],
                names=["doc", "row_key", "line", "node", "keys"],
            )

    return over_batches(rows, work, "doc long, row_key long, line int, node long, keys binary")


def texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The plain form of the given lines."""
    bits = sieve(nodes, "node")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "text", 2_000_000)):
            found = {content(line): line for text in part.column("text").to_pylist() for _, line in comparable(text)}
            node = np.fromiter(found, np.int64, len(found))
            place = node & (len(bits) * 8 - 1)
            on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            lines = [line for line, wanted in zip(found.values(), on) if wanted]
            yield pa.RecordBatch.from_arrays([pa.array(node[on]), pa.array(lines, pa.string())], names=["node", "text"])

    return over_batches(rows.select("text"), work, "node long, text string").join(nodes, "node").groupBy("node").agg(F.min("text").alias("text"))


def dropped_lines(rows: DataFrame) -> DataFrame:
    """(doc, row_key, drop): numbers of the lines that repeat an earlier one."""
    lines = stored(all_lines(rows), "lines")
    component = linked(lines.select("node", "keys"), lambda nodes: texts_of(rows, nodes), line_sets, SHARE, BANDS)
    again = lines.groupBy("node").count().where("count > 1").select("node")
    repeated = again.join(component, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
    repeated = stored(repeated, "repeated-lines")
    met = sifted(lines.select("doc", "row_key", "line", "node"), "node", sieve(repeated, "node")).join(repeated, "node")
    met = stored(met.drop("node"), "lines-with-like")
    place = F.struct("doc", "row_key", "line")
    stays = stored(met.groupBy("component").agg(F.min(place).alias("stays")), "first-lines")
    gone = met.join(stays, "component").where(place != F.col("stays"))
    return gone.groupBy("doc", "row_key").agg(F.collect_list("line").alias("drop"))


def remove_lines(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every row with its doc_id (or the columns of `keep`), text without repeated lines, n_lines, n_removed and kept_sha256.

    Lines end at a line feed. Two lines are linked if 0.8 of the character shingles that they have, case and white space
    aside, are common; linked lines form components over the whole corpus, of which the first line by (doc_id, line)
    stays. Lines shorter than a shingle are never removed. A missing text stays missing and has no lines; a missing doc_id counts as the
    largest; repeated rows of one doc_id and text count as one and keep the same lines.
    """
    keep = keep or ["doc_id"]
    kinds = dict(documents.dtypes)
    rows = documents.select(
        *[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"),
        F.coalesce("doc_id", F.lit(LAST)).alias("_doc"), F.xxhash64("text").alias("_row_key"),
    )
    plain_rows = rows.select(F.col("_doc").alias("doc"), F.col("_row_key").alias("row_key"), F.col("_text").alias("text"))
    drop = dropped_lines(plain_rows).select(F.col("doc").alias("_doc"), F.col("row_key").alias("_row_key"), F.col("drop").alias("_drop"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "_text")):
            texts, total, gone = [], [], []
            for text, drop in zip(part.column("_text").to_pylist(), part.column("_drop").to_pylist()):
                lines = [] if text is None else text.split("\n")
                out = set(drop or ())
                texts.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in out))
                total.append(len(lines))
                gone.append(len(out))
            digest = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                names=[*keep, "kept_text", "n_lines", "n_removed", "kept_sha256"],
            )

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", kept_text string, n_lines long, n_removed long, kept_sha256 string"
    return over_batches(rows.join(drop, ["_doc", "_row_key"], "left").drop("_doc", "_row_key"), work, schema)
