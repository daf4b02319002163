"""The learned operators against a slow evaluation of their own models, and the recall of candidate search near the threshold."""

from __future__ import annotations

import math

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from tests_llm_shared import CLASHES, SMALL, Groups, corpus, links  # noqa: F401 - fixtures

from funnelworks.llm import language, lines, neardup, quality

MASK = 2**64 - 1


def grams_by_hand(text):
    """Damped counts of the hashed runs of one to four bytes, one byte after the other."""
    plain = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    plain = [32 if b < 128 and not 97 <= b <= 122 else b for b in plain]
    counts = {}
    for i in range(len(plain)):
        key = 0
        for b in plain[i : i + 4]:
            key = (key * 257 + b + 1) & MASK
            place = (key * 0x9E3779B97F4A7C15 & MASK) >> 52
            counts[place] = counts.get(place, 0) + 1
    damped = {k: math.sqrt(n) for k, n in counts.items()}
    length = math.sqrt(sum(x * x for x in damped.values()))
    return {k: x / length for k, x in damped.items()}


def predicted_by_hand(model, grams):
    """The family with the largest margin, then in it the language with the most votes; its least sure vote is the score."""
    margin = lambda w: sum(x * float(w[k]) for k, x in grams.items()) + float(w[-1])
    sure = lambda m: 1 / (1 + math.exp(-max(-30.0, min(30.0, 3 * m))))
    family_of = lambda g: language.FAMILY_OF.get(g, g)
    if len(model.families) > 1:
        margins = [margin(w) for w in model.top]
        best = max(range(len(margins)), key=lambda f: margins[f])
        family, score = model.families[best], sure(margins[best])
    else:
        family, score = model.families[0], 1.0
    votes = {i: 0.0 for i, g in enumerate(model.languages) if family_of(g) == family}
    least = dict.fromkeys(votes, 1.0)
    for (a, b), w in zip(model.pairs, model.within):
        if a in votes:
            p = sure(margin(w))
            for i, x in ((a, p), (b, 1 - p)):
                votes[i] += x
                least[i] = min(least[i], x)
    winner = max(votes, key=lambda i: votes[i])
    return model.languages[winner], score * least[winner]


def test_languages_of_every_document_by_hand(spark, corpus):
    rows, df = corpus
    model = language.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert len(model.families) > 1 and model.pairs
    got = {}
    for r in language.identify(df, model, ["doc_id", "text"]).collect():
        got[r.doc_id, r.text] = (r.lang_pred, r.score)
    for key in set(rows):
        text = key[1]
        if text is None or not any(c.isalpha() for c in text):
            assert got[key] == ("und", 0.0)
            continue
        want, score = predicted_by_hand(model, grams_by_hand(text))
        assert got[key][0] == want and got[key][1] == pytest.approx(score, abs=2e-5), key


def test_quality_of_every_document_by_hand(spark, corpus):
    rows, df = corpus
    model = quality.fit(df, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert model.constant is None
    size = lambda raw, content: len(
        zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False
        ).compress(raw)
    )
    got = {}
    for r in quality.score(df, model).collect():
        got.setdefault(r.doc_id, []).append((r.score, r.predicted))
    want = {}
    for doc, text in rows:
        raw = (text or "").encode()
        parts = [raw[i : i + quality.BLOCK] for i in range(0, len(raw), quality.BLOCK)] or [b""]
        good, bad = (sum(size(p, content) - 4 for p in parts) for content in (model.good, model.bad))
        n = max(len(raw), 1)
        ratio = math.log(max(bad, 1) / max(good, 1))
        x = (1, 5 * ratio, 20 * (bad - good) / n, 2 * good / n, math.log(n + 10) / 5, 5 * good / n * ratio)
        score = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(x, model.weights))))))
        want.setdefault(doc, []).append((score, int(score >= 0.3)))
    assert set(got) == set(want)
    for doc, scores in want.items():
        for (a, p), (b, q) in zip(sorted(got[doc]), sorted(scores)):
            assert a == pytest.approx(b, abs=1e-9) and (p == q or abs(b - 0.3) < 1e-9)


def test_odd_labels(spark, corpus):
    """Null, repeated, contradicting and unknown labels, labels of missing documents, and clashing names."""
    _, df = corpus
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, -1), (10**9, 1), (10**9, 0)], "doc_id long, quality int")
    more = labels.unionByName(labels).unionByName(odd).withColumns({c: F.lit("extra") for c in [*CLASHES, "text", "held_out", "y", "n"]})
    plain, mixed = quality.fit(df, labels), quality.fit(df, more)
    assert mixed.good == plain.good and mixed.bad == plain.bad and mixed.weights == pytest.approx(plain.weights)
    nothing = quality.fit(df, odd.where("quality IS NULL"))
    assert nothing.constant == 0.5 and {r.score for r in quality.score(df, nothing).collect()} == {0.5}


def near(rng, words, size, low, high):
    """A text whose set of runs of `size` words has a similarity between low and high with that of `words`."""
    runs = lambda w: {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    while True:
        other = list(words)
        for i in rng.choice(len(other), int(rng.integers(1, 1 + len(other) // 10)), replace=False):
            other[i] = f"x{rng.integers(10**9)}"
        a, b = runs(words), runs(other)
        if low <= len(a & b) / len(a | b) < high:
            return other


def test_recall_of_documents_near_the_threshold(spark):
    rng = np.random.default_rng(11)
    texts = []
    for family in range(700):
        words = [f"f{family}w{i}" for i in range(int(rng.integers(60, 160)))]
        texts += [words, near(rng, words, 2, 0.80, 0.85)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in neardup.groups(df, size=2).collect()}
    linked = [found[2 * k] == found[2 * k + 1] == 2 * k for k in range(700)]
    assert sum(linked) >= 699 and len(set(found.values())) == 700 + linked.count(False)


def test_recall_of_lines_near_the_threshold(spark):
    rng = np.random.default_rng(12)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    texts = []
    sets = lambda t: frozenset(t[i : i + lines.SHINGLE] for i in range(len(t) - lines.SHINGLE + 1))
    while len(texts) < 1200:
        line = "".join(rng.choice(list(letters), int(rng.integers(60, 200))))
        other = list(line)
        for i in rng.choice(len(line), int(rng.integers(1, 4)), replace=False):
            other[i] = "#"
        other = "".join(other)
        a, b = sets(line), sets(other)
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            texts += [line, other]
    groups = Groups(range(len(texts)))
    for a, b in links([sets(t) for t in texts], *lines.SHARE):
        groups.link(a, b)
    surplus = len(texts) - len({groups.of(i) for i in range(len(texts))})
    assert surplus == 600
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    removed = sum(r.n_removed for r in lines.remove_lines(df).collect())
    assert removed >= surplus - 1
