"""Language identification in two steps: the family, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import CACHED_BYTES, held_out, lower_ascii, over_batches, slices, text_bytes

#: Families of closely related languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
#: Documents per language to learn from (expected number; whole texts), and dimensions of the hashed n-grams.
SAMPLE, WIDTH = 500, 4096
UNKNOWN = "und"


def ngrams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed counts of one to four neighbouring bytes per text, damped and scaled to length 1. Case and ASCII signs do
    not count; n-grams across two texts are left out."""
    n, texts = len(raw), len(offsets) - 1
    plain = lower_ascii(raw)
    plain = np.where((plain < 128) & ~((plain >= 97) & (plain <= 122)), np.uint8(32), plain).astype(np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    last = offsets[1:][owner] - np.arange(n) if n else np.empty(0, np.int64)  # bytes left in the text
    out = np.zeros(texts * WIDTH)
    key = np.zeros(n, np.uint64)
    for size in range(1, 5):
        m = n - size + 1
        if m <= 0:
            break
        key = key[:m] * np.uint64(257) + plain[size - 1 :] + np.uint64(1)
        spread = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
        whole = last[:m] >= size
        out += np.bincount(owner[:m][whole] * WIDTH + spread[whole].astype(np.int64), minlength=texts * WIDTH)
    out = np.sqrt(out.reshape(texts, WIDTH))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    return out.astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, cost: float = 20.0, rounds: int = 80) -> np.ndarray:
    """Linear support vector machine with squared hinge loss (y: 1 and -1, classes weighted alike), by accelerated
    gradient steps; the last column of x is 1, its weight the bias."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost
    step = 1 / (1 + 4 * cost)
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - np.float32(step) * (v - 2 * x.T @ (weight * y * slack).astype(np.float32))
        w, v = new, new + np.float32(k / (k + 3)) * (new - w)
    return w


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...] = ()
    families: tuple[str, ...] = ()
    #: A row of weights per family (against all others) and per pair of languages of one family.
    top: np.ndarray = field(default_factory=lambda: np.zeros((0, WIDTH + 1)))
    pairs: tuple[tuple[int, int], ...] = ()
    within: np.ndarray = field(default_factory=lambda: np.zeros((0, WIDTH + 1)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and its score, for each row of n-grams."""
        sure = lambda margin: 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))
        member = np.array([self.families.index(FAMILY_OF.get(g, g)) for g in self.languages])
        if len(self.families) > 1:
            top = x @ self.top[:, :-1].T + self.top[:, -1]
            family, first = top.argmax(1), sure(top.max(1))
        else:
            family, first = np.zeros(len(x), int), np.ones(len(x))
        votes = np.zeros((len(x), len(self.languages)))
        support = np.ones((len(x), len(self.languages)))
        for (a, b), w in zip(self.pairs, self.within):
            p = sure(x @ w[:-1] + w[-1])
            votes[:, a] += p
            votes[:, b] += 1 - p
            support[:, a] = np.minimum(support[:, a], p)
            support[:, b] = np.minimum(support[:, b], 1 - p)
        votes[member[None, :] != family[:, None]] = -1
        best = votes.argmax(1)
        return best, first * support[np.arange(len(x)), best]


def train(texts: list[str], langs: list[str]) -> Model:
    return learn(ngrams(*text_bytes(pa.array(texts, pa.string()))), langs)


def learn(grams: np.ndarray, langs: list[str]) -> Model:
    """The model of rows of n-grams and their languages."""
    if not langs:
        return Model()
    x = np.column_stack([grams, np.ones(len(langs), np.float32)])
    languages = tuple(sorted(set(langs)))
    families = tuple(sorted({FAMILY_OF.get(g, g) for g in languages}))
    lang = np.array([languages.index(g) for g in langs])
    family = np.array([families.index(FAMILY_OF.get(g, g)) for g in langs])
    top = [machine(x, np.where(family == f, 1.0, -1.0)) for f in range(len(families))] if len(families) > 1 else []
    pairs, within = [], []
    for a, b in combinations(range(len(languages)), 2):
        if FAMILY_OF.get(languages[a], languages[a]) == FAMILY_OF.get(languages[b], languages[b]):
            rows = (lang == a) | (lang == b)
            pairs.append((a, b))
            within.append(machine(x[rows], np.where(lang[rows] == a, 1.0, -1.0)))
    shape = lambda rows: np.array(rows).reshape(-1, WIDTH + 1)
    return Model(languages, families, shape(top), tuple(pairs), shape(within))


def fit(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the whole texts of about `sample` documents per language, none of them held out, drawn by a hash of the
    doc_id with a rate that follows from the count of the language. Only their n-grams, 4 * WIDTH bytes each, are collected."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "text", CACHED_BYTES)):
            grams = [row.tobytes() for row in ngrams(*text_bytes(part.column("text")))]
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(grams, pa.binary())], names=["lang", "grams"])

    rows = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(), F.lit(True)))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return Model()
    rate = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, min(1.0, sample / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    drawn = over_batches(rows.where(place < rate[F.col("lang")]).select("lang", "text"), work, "lang string, grams binary")
    got = sorted((r.lang, bytes(r.grams)) for r in drawn.collect())
    grams = np.frombuffer(b"".join(g for _, g in got), np.float32).reshape(-1, WIDTH)
    return learn(grams, [lang for lang, _ in got])


def identify(documents: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Every row with held_out, lang_pred and score beside its doc_id and the columns of `keep`.

    A missing text, or one without any letter, is `und` with score 0, and so is everything if there was nothing to learn
    from. Whole texts are read. A missing doc_id counts as held out.
    """
    keep = keep or ["doc_id"]
    text = "text" if "text" in keep else "_text"
    kinds = dict(documents.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", held_out boolean, lang_pred string, score double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, text, CACHED_BYTES):
                column = part.column(text)
                readable = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                best, score = np.full(part.num_rows, len(model.languages)), np.zeros(part.num_rows)
                if model.languages and readable.any():
                    found, sure = model.predict(ngrams(*text_bytes(column)))
                    best, score = np.where(readable, found, best), np.where(readable, sure, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), part.column("_held"), pa.array(names[best], pa.string()), pa.array(score)],
                    names=[*keep, "held_out", "lang_pred", "score"],
                )

    more = [] if text in keep else [F.col("text").alias(text)]  # a text goes to Python once
    rows = documents.select(*[F.col(f"`{c}`") for c in keep], *more, F.coalesce(held_out(), F.lit(True)).alias("_held"))
    return over_batches(rows, work, schema)
