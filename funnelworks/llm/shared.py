"""What the operators share: written intermediate tables, Arrow batches of bounded size, words and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: Rows and bytes that go to Python at a time, whichever is reached first; a row that is larger is a batch of its own.
BATCH_ROWS = 1000
ARROW_BYTES = 8_000_000
#: Bytes of text that a task turns into arrays at a time.
BATCH_BYTES = 4_000_000
#: The same where each byte passes through many array operations: their results stay in the processor's cache.
CACHED_BYTES = 300_000
#: White space between words, the same in the JVM, in Python's bytes.split() and in the expected results.
BLANK = r"[\x20\x09-\x0D]+"
#: Stands for a missing doc_id in comparisons: the largest of all.
LAST = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends here and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes what `stored` has written for a frame that nothing reads any more; the folder must be one of its own."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def over_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow with batches that bound the memory of a Python worker."""
    bounded(df.sparkSession)
    return df.mapInArrow(work, schema)


def bounded(spark: SparkSession) -> None:
    """From now on, batches that go to Python have a bounded number of rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about `limit` bytes together; a longer text is a part of its own."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if batch.num_rows > start:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the offsets of each text; a missing text has no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
    return raw, ends - ends[0]


def as_bytes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The parts of an array of 64-bit numbers as bytes, a value each: less work than lists where rows are written or read."""
    ends = pa.py_buffer((bounds * 8).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values))])


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit numbers of all values of `as_bytes` one after the other, and the offsets of each value."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.int64), np.cumsum([0, *map(len, values)]) // 8


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of its first word (one more entry at the end)."""
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    inner = offsets[1:-1]
    before[inner[inner < n]] = True
    after[inner[inner > 0] - 1] = True
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BYTES = np.random.default_rng(20240611).integers(0, 2**64, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next batch."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run values[start:end]: equal runs have equal hashes wherever they stand."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_ODD, n), out=sums[1:])
    inverse = powers(_INVERSE, n + 1)
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values without repeats."""
    values = np.sort(values)
    new = values[1:] != values[:-1]
    return values if new.all() else values[np.concatenate([[True], new])]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(_BYTES[raw], starts, ends)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    upper = (raw >= 65) & (raw <= 90)
    return raw + (upper * np.uint8(32))


def held_out() -> Column:
    """Rows that no model may learn from: a fifth of the documents by the checksum of their doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
