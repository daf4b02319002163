"""Quality classifier from compression: the class whose dictionary shortens a text more is the likelier one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import held_out, over_batches, slices, stored

#: Documents per class that the dictionaries, and as many again that the calibration may learn from (expected numbers).
SAMPLE = 2000
#: Pieces of a sampled text that go into a dictionary, from anywhere in the text.
PIECES = 4
#: Bytes of a dictionary, of a piece, and of the blocks in which texts are compressed: longer blocks would learn from themselves.
DICTIONARY, PIECE, BLOCK, LEVEL = 112_640, 1000, 2000, 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """Dictionaries (None: that class was never seen) and the weights of the calibration."""

    good: bytes | None
    bad: bytes | None
    weights: tuple[float, ...]

    @property
    def constant(self) -> float | None:
        """The score of every text where there is only one class, or none, to learn from."""
        if self.good is not None and self.bad is not None:
            return None
        return 1.0 if self.good is not None else 0.0 if self.bad is not None else 0.5


def pieces_of(text: str | None) -> list[bytes]:
    """The pieces of a text that have the smallest hashes, in their order."""
    raw = (text or "").encode()
    found = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
    if len(found) <= PIECES:
        return found
    return [found[k] for k in sorted(sorted(range(len(found)), key=lambda k: xxhash.xxh3_64_intdigest(found[k], k))[:PIECES])]


def dictionary(texts: list[list[bytes]]) -> bytes | None:
    pieces = [piece for text in texts for piece in text]
    if not pieces:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"\n".join(pieces)[:DICTIONARY]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False
    )


def sizes(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """Bytes of each whole text with the good and with the bad dictionary, and without compression."""
    by = [compressor(good), compressor(bad)]
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        blocks = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)] or [b""]
        out[i] = [*(sum(len(c.compress(b)) - 4 for b in blocks) for c in by), len(raw)]
    return out


def features(size: np.ndarray) -> np.ndarray:
    """The size difference, per byte and relative to the compressed size, and what its meaning depends on."""
    good, bad, n = size.T
    n = np.maximum(n, 1)
    ratio = np.log(np.maximum(bad, 1) / np.maximum(good, 1))
    share = good / n
    return np.column_stack([np.ones(len(n)), 5 * ratio, 20 * (bad - good) / n, 2 * share, np.log(n + 10) / 5, 5 * share * ratio])


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic curve, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = curve(x, w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def curve(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from about 2 * `sample` labelled documents per class, none of them held out.

    The sample is drawn from the labels by a hash of the doc_id, with a rate per class that follows from its count, so it
    has about the same size at any scale and can be broadcast to the documents.
    """
    marked = (
        labels.where(F.col("quality").isin(0, 1) & ~F.coalesce(held_out(), F.lit(True)))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    count = {r.quality: r["count"] for r in marked.groupBy("quality").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    rate = F.when(F.col("quality") == 1, min(1.0, 2 * sample / count.get(1, 1))).otherwise(
        min(1.0, 2 * sample / count.get(0, 1))
    )
    drawn = marked.where(place < rate).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    rows = stored(documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), "quality-sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = [pieces_of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(pieces, pa.list_(pa.binary()))], names=["quality", "pieces"])

    first = over_batches(rows.where("part = 0").select("quality", "text"), cut, "quality int, pieces array<binary>")
    texts: dict[int, list[list[bytes]]] = {0: [], 1: []}
    for row in first.toLocalIterator():
        texts[row.quality].append([bytes(piece) for piece in row.pieces])
    good, bad = dictionary(sorted(texts[1])), dictionary(sorted(texts[0]))
    if good is None or bad is None:
        return Model(good, bad, ())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = sizes(batch.column("text").to_pylist(), good, bad)
            yield pa.RecordBatch.from_arrays([batch.column("quality"), *map(pa.array, size.T)], names=["y", "g", "b", "n"])

    measured = over_batches(rows.where("part = 1").select("quality", "text"), work, "y int, g double, b double, n double")
    got = np.array(sorted(map(tuple, measured.collect())), float).reshape(-1, 4)
    return Model(good, bad, tuple(calibrate(features(got[:, 1:]), got[:, 0])))


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted. A missing text counts as empty and is scored as such; rows
    are scored one by one, so repeated rows get equal scores; a missing doc_id counts as held out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.array(model.weights)
        for batch in batches:
            for part in slices(batch, "text"):
                if model.constant is None:
                    found = curve(features(sizes(part.column("text").to_pylist(), model.good, model.bad)), weights)
                else:
                    found = np.full(part.num_rows, model.constant)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = documents.select("doc_id", "text", F.coalesce(held_out(), F.lit(True)).alias("held_out"))
    return over_batches(rows, work, "doc_id long, held_out boolean, score double, predicted int")
